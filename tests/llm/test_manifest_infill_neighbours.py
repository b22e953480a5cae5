"""Merkle manifest, fill-in-the-middle and nearest neighbours against plain Python, and the cases of their docstrings."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoloom.llm import infill, merkle, neighbours

SF = "/root/testdata/sf0.001"
#: More columns than the operators ask for, named like those that they use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, pos long, path string, digest string, row long, form string, piece string, n long, place long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), "g", 1, "p", "d", 1, "f", "p", 1, 1) for i, t, lang in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified), by lists in one process."""

    def leaf(i, text, lang):
        fields = [i, "s", lang, None if text is None else len(text), text]
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    def tree(digests):
        layers = [digests]
        while len(layers[-1]) > 1:
            layers.append([sha("".join(layers[-1][k : k + 8])) for k in range(0, len(layers[-1]), 8)])
        return layers

    def steps(layers, at):
        for layer in layers[:-1]:
            low = at // 8 * 8
            yield "".join(layer[low:at]), "".join(layer[at + 1 : low + 8])
            at //= 8

    groups = {}
    for i, text, lang in rows:
        change = i is not None and zlib.crc32(str(i).encode()) % 3 == 0 and text is not None
        forged = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if change else text
        n = None if text is None else len(text)
        own = leaf(i, text, lang)
        other = sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in [i, "s", lang, n, forged]))
        groups.setdefault(lang, []).append(((i is not None, i or 0), own, other, i))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    layers = {g: tree([r[1] for r in sorted(groups[g])]) for g in names}
    top = tree([layers[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, (_, own, other, i) in enumerate(sorted(groups[g])):
            path = [*steps(layers[g], at), *steps(top, k)]
            folded = other
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((i, own, layers[g][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


MERKLE = "doc_id leaf subroot root proof_sha256 folded_root verified".split()


def manifest_rows(docs):
    rows = merkle.manifest(docs, carry={"forged": merkle.tampered(docs)})
    rows = rows.withColumn("folded_root", merkle.fold(F.col("forged"), F.col("path"))).withColumn("verified", F.col("folded_root") == F.col("root"))
    rows = rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("counts", [{"a": 1}, {"a": 8, "b": 9, None: 65, "": 1}, {"a": 513, "é": 64, "z": 512}, {f"l{k}": 1 + k % 3 for k in range(70)}])
def test_manifest(spark, counts):
    rows = [(i * 7 % 10_007, f"Text {i} É{'x' * (i % 5)}", lang) for lang, n in counts.items() for i in range(n)]
    assert manifest_rows(frame(spark, rows)) == plain_manifest(rows)


def test_manifest_cases(spark):
    long_text = "Aé𝔘 " * 100_000
    rows = [(None, None, None), (None, "A", None), (3, None, "en"), (3, None, "en"), (3, "ABC", "en"), (3, "ABC", "en"), (4, "", "en"), (5, long_text, "en"), (-6, "Z", "en"), (12, "no capitals", "de")]
    rows += [(i, "Capital", "fr") for i in range(12)]
    got = manifest_rows(frame(spark, rows))
    assert got == plain_manifest(rows) and any(r[-1] for r in got) and not all(r[-1] for r in got)
    assert manifest_rows(frame(spark, rows).limit(0)) == []


def test_manifest_proofs_and_groups(spark):
    rows = merkle.manifest(frame(spark, [(i, str(i), "a") for i in range(20)]), fields=["text"], group="lang", order="text").collect()
    for r in rows:
        digest = r["leaf"]
        for left, right in r["path"]:
            digest = sha(left + digest + right)
        assert digest == r["root"] and r["leaf"] == sha(f"{len(r['key'])}:{r['key']}")
    assert [r["pos"] for r in sorted(rows, key=lambda r: r["key"])] == list(range(20))


def plain_infill(i, text):
    text = text or ""
    n, h = len(text), sha(f"1:{'' if i is None else i}")
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (i, n, "plain", None, None, sha(text), sha(text)), text
    p, m, s = text[:a], text[a:b], text[b:]
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return (i, n, form, a, b - a, sha(out), sha(text)), out


INFILL = [(i, f"<é{'𝔘a<' * (i % 40)}>S><" + "P" * (i % 3), "en") for i in range(200)]
INFILL += [(None, None, None), (None, "x", "en"), (7, "", "en"), (7, "twice", "en"), (7, "twice", "en"), (8, "has <M> inside", "en"), (9, "aé𝔘" * 100_000, "en"), (10, "<", "en"), (11, " \n", "en"), (-3, "Below zero.", "en")]


@pytest.mark.parametrize("chunk", [1, 7, infill.CHUNK])
def test_infill(spark, chunk):
    rows = INFILL if chunk > 1 else [r for r in INFILL if len(r[1] or "") < 1_000]
    made = infill.pieces(frame(spark, rows), chunk=chunk)
    got = infill.restore(made).collect()
    shown = [(r["doc_id"], r["n"], r["form"], *((None, None) if r["form"] == "plain" else (r["cut"], r["stop"] - r["cut"])), r["output_sha256"], r["restored_sha256"]) for r in got]
    want = [plain_infill(i, t) for i, t, _ in rows]
    assert sorted(shown, key=repr) == sorted((w[0] for w in want), key=repr)
    assert {"psm", "spm", "plain"} == {w[0][2] for w in want}
    outputs = [(r["doc_id"], r["form"], r["text"]) for r in infill.texts(made).collect()]
    assert sorted(outputs, key=repr) == sorted(((w[0][0], w[0][2], w[1]) for w in want), key=repr)


def test_infill_pieces(spark):
    made = infill.pieces(frame(spark, INFILL), chunk=50)
    assert made.agg(F.max(F.length("piece"))).first()[0] <= 50 * 4 + 3
    assert made.withColumn("at", F.spark_partition_id()).groupBy("row").agg(F.countDistinct("at").alias("n")).where("n > 1").count() == 0
    assert infill.restore(infill.pieces(frame(spark, INFILL).limit(0))).count() == infill.texts(infill.pieces(frame(spark, INFILL).limit(0))).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, bucket long, ids string, asker long, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2, 0.5) for i, v in rows], VECTORS)


def found(frame, every=50, **options):
    out = {}
    for r in sorted(neighbours.nearest(frame, F.col("vec_id") % every == 0, **options).collect()):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_neighbours_recall(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    ids, matrix = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    matrix /= np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    got = found(table)
    assert set(got) == {i for i in ids.tolist() if i % 50 == 0}
    hits = 0
    for i, near in got.items():
        scores = matrix @ matrix[ids == i][0]
        scores[ids == i] = -9
        best = set(ids[np.argsort(-scores, kind="stable")[:5]].tolist())
        hits += len(best & {j for j, _ in near})
        assert len(near) == 5 and all(abs(scores[ids == j][0] - s) < 1e-12 for j, s in near) and [s for _, s in near] == sorted((s for _, s in near), reverse=True)
    assert hits >= 0.95 * 5 * len(got)


def test_neighbours_cases(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(40)]
    rows += [(100, None), (150, [0.0] * 8), (200, [None] + [1.0] * 7), (250, [float("nan")] * 8), (300, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (350, []), (400, [1.0, 2.0, 3.0]), (401, [1.0, 2.0, 2.0])]
    rows += [(1_000 + i, [1.0] * 8) for i in range(200)] + [(0, rows[0][1])]  # copies of one vector, and a repeated row
    table = vectors(spark, rows)
    want = neighbours.brute_force(list({i: (i, v) for i, v in vectors(spark, rows).select("vec_id", "embedding").rdd.map(tuple).collect()}.values()))
    got = found(table, tables=40, probes=6)
    assert set(got) == {i for i in want if i % 50 == 0}
    for i, near in got.items():
        assert [j for j, _ in near] == [j for j, _ in want[i]] and np.allclose([s for _, s in near], [s for _, s in want[i]], atol=1e-12)
    assert [j for j, _ in got[1_100]] == [1_000, 1_001, 1_002, 1_003, 1_004] and [j for j, _ in got[1_000]] == [1_001, 1_002, 1_003, 1_004, 1_005]
    assert [j for j, _ in got[400]] == [401]
    assert found(table.limit(0)) == {} and found(vectors(spark, [(0, [1.0, 2.0])])) == {}
    assert {i: [j for j, _ in n] for i, n in found(vectors(spark, [(0, [1.0, 2.0]), (3, [-1.0, -2.0]), (2, [2.0, -1.0])])).items()} == {0: [2, 3]}


def test_neighbours_hashing():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(50, 48))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    padded = np.pad(rows, ((0, 0), (0, 16)))
    assert np.allclose(np.linalg.norm(neighbours.hadamard(padded), axis=1), 1) and np.allclose(neighbours.hadamard(neighbours.hadamard(padded)), padded)
    near, far = neighbours.axes(rows, 0, 4, 3), neighbours.axes(-rows, 0, 4, 3)
    assert (near ^ 1 == far).all() and (neighbours.axes(rows, 1, 4) != neighbours.axes(rows, 0, 4)).any()
    huge = neighbours._unit([np.array([1e38, 1e-38], dtype="<f4").tobytes(), np.array([1e-40, 0], dtype="<f4").tobytes()], "<f4")
    assert np.allclose(huge, [[1, 0], [1, 0]])
