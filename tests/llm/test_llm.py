"""The training-data operators: brute force, round trips and the cases that each docstring states."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoloom.llm import common, components, decontaminate, html_extract, licenses, line_dedup, minhash, mixing, quality_rules, substring_dedup, surrogates, token_files
from cartoloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, spans string"


def words(a, b, tag="w"):
    return " ".join(f"{tag}{i}" for i in range(a, b))


def frame(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or {}).get(i, "s"), len(t or ""), 1, True, "x") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


LONG = words(0, 400)
CASES = [(0, None), (1, ""), (2, " \n\t"), (3, LONG), (4, LONG), (5, LONG.replace("w7 ", "v7 ")), (6, words(100, 180, "z") + " " + words(50, 120)), (7, "short one."), (7, "short one."), (8, words(0, 3_000, "q"))]


@pytest.fixture(scope="module")
def cases(spark):
    return frame(spark, CASES).cache()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(ORACLES[name])
    columns = sorted(c[0] for c in want.description)
    order = [[c[0] for c in want.description].index(c) for c in columns]
    rows = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == rows


def test_quality_rules_cases(spark, cases):
    rows = {r["doc_id"]: r for r in quality_rules.judge(cases).collect()}
    assert rows[0]["n_words"] == rows[1]["n_words"] == rows[2]["n_words"] == 0 and not rows[0]["kept"]
    assert rows[3]["kept"] and rows[3]["n_words"] == 400 and rows[3]["n_repeat_words"] == 0
    twice = frame(spark, [(1, words(0, 30) + " " + words(0, 30)), (2, "Home | About | Contact | Help\n" + words(0, 40) + ".")])
    rows = {r["doc_id"]: r for r in quality_rules.judge(twice).collect()}
    assert rows[1]["n_repeat_words"] == 60 and rows[1]["base_failed"]
    assert rows[2]["kept"] and rows[2]["clean_text"] == words(0, 40) + "."


def test_decontaminate_brute_force(spark, cases):
    items = [("a", words(50, 70)), ("b", "w3 w4"), ("c", None), ("d", "..."), ("b", "w3 w4"), ("e", words(100, 110, "Z"))]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    for block in (10, 2_000_000):
        got = decontaminate.find(cases, benchmark, block_words=block).select("doc_id", "text", "n_words", decontaminate.n_hit(F.col("spans")).alias("n"), "items").collect()
        for r in got:
            (want,) = decontaminate.brute_force([r["text"]], items)
            assert (r["n_words"], r["n"], r["items"]) == (want[0], want[1], sorted(set(want[2])))
    assert decontaminate.find(cases, benchmark.limit(0)).where("size(spans) > 0").count() == 0
    assert decontaminate.cut("A, b c! d", [[1, 3]]) == "A, ! d"


def test_token_files_round_trip(spark, cases):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    odd = [(20, "İstanbul ΑΣ x<|endoftext|>y it's WE'LL !'s ²³ ½ É×÷ ª µ\x1c\x85 a\xa0b"), (None, "no id")]
    docs = cases.unionByName(frame(spark, odd))
    folder = common.shared_folder(spark, "test-tokens")
    token_files.write_tokens(docs, folder, path)
    rows = token_files.read_tokens(spark, folder, digest_only=False).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(path)
    want = sorted([*CASES, *odd], key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r["doc_id"] for r in rows] == [k for k, _ in want]
    at = 0
    for r in rows:
        assert r["start"] == at and len(r["ids"]) == r["n_tokens"]
        at += r["n_tokens"]
    texts = {k: t for k, t in want}
    assert all(r["ids"] == tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [2] for r in rows)


def test_substring_dedup_edges(spark, cases):
    rows = {r["id"]: r for r in substring_dedup.duplicate_spans(cases).collect()}
    assert rows[3]["spans"] == [] and rows[4]["spans"] == [[0, 400]] and rows[0]["n_words"] == 0
    assert rows[5]["spans"] == [[8, 400]] and rows[6]["spans"] == [[80, 150]] and rows[8]["spans"] == []


@pytest.mark.parametrize("width", [2, 5])
def test_minhash_brute_force(spark, cases, width):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = docs[:120] + [(1000 + k, t) for k, t in CASES]
    got = minhash.near_duplicates(frame(spark, docs), width=width).collect()
    assert {r["id"]: r["component_id"] for r in got} == minhash.brute_force(docs, width) and len(got) == len(docs)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (5, 5), (3, 1)], "a long, b long")
    assert {r["node"]: r["root"] for r in components.components(edges).collect()} == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 5: 5}


def test_mixing(spark):
    assert mixing.min_cost_flow([10, 10], [[0, 1], [1]], [5, 15]) == [[5, 5], [10]]
    assert [float(t) for t in mixing.level_targets([10, 1000, 20], [3, 1, 2])] == [20.0, 1485.0, 40.0]
    docs = frame(spark, [(i, words(0, i % 9)) for i in range(300)] + [(None, "a b"), (3, None)], {i: None if i % 3 == 0 else "ab"[i % 2] for i in range(300)})
    runs = [sorted((tuple(r) for r in mixing.mix(docs).select("doc_id", "source", "size", "target", "copies").collect()), key=repr) for _ in range(2)]
    assert runs[0] == runs[1] and all(0 <= r[4] <= 2 for r in runs[0])
    for source in {r[1] for r in runs[0]}:
        own = [r for r in runs[0] if r[1] == source]
        assert abs(sum(r[2] * r[4] for r in own) - own[0][3]) <= 2
    assert mixing.mix(docs.limit(0)).count() == 0


def test_html_extract(spark):
    page = "<html><head><title>t</title></head><body><nav><a>x</a></nav><div class='ad'>buy</div><article><h1>Top &amp; so</h1><p>One<br> two<p>Three</article><footer>f</footer>"
    plain = "<body><div>shared words that every page of this host has on top</div><p>{} tells its own story</p></body>"
    rows = [(1, "http://a.example/1", page), (2, "http://a.example/2", plain.format("b")), (3, "http://a.example/3", plain.format("c")), (4, None, None), (5, "u", "")]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "Top & so\n\nOne two\n\nThree", 2: "b tells its own story", 3: "c tells its own story", 4: "", 5: ""}


def test_html_extract_hot_host(spark):
    rng = np.random.default_rng(2)
    menu = "<div>shared words that every page of this host has on top</div>"
    rows = [(i, f"http://h.example/{i}", f"<body>{menu}<p>{' '.join(f't{x}' for x in rng.integers(0, 10**9, 30))}</p></body>") for i in range(40)]
    rows += [(100, "http://h.example/100", f"<body><p>{words(0, 20, 'pair')}</p><p>first of the pair</p></body>"), (101, "http://h.example/101", f"<body><p>{words(0, 20, 'pair')}</p><p>second of the pair</p></body>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole, cut = ({r["page_id"]: r["text"] for r in html_extract.extract(pages, host_tokens=n).collect()} for n in (10**6, 60))
    assert whole == cut and whole[100] == "first of the pair" and whole[101] == "second of the pair" and all("shared" not in t for t in cut.values())


def test_html_extract_copies(spark):
    page = "<body><p>one article in many copies with more than eight words</p><p>and its end that only these copies of it have at all</p></body>"
    joined = page.replace("</p><p>", " ")  # the same words in one block
    rows = [(1, "http://h.example/1", page), (1, "http://h.example/1", page), (2, "http://h.example/1?utm=x", page), (3, "http://h.example/1/print", joined), (4, "http://h.example/4", "<body><p>" + words(0, 9) + "</p></body>")]
    for host_tokens in (html_extract.HOST_TOKENS, 10):
        got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), host_tokens=host_tokens).collect()
        text = "one article in many copies with more than eight words\n\nand its end that only these copies of it have at all"
        assert sorted((r["page_id"], r["text"]) for r in got) == [(1, text), (1, text), (2, text), (3, text.replace("\n\n", " ")), (4, words(0, 9))]


def test_suffix_array_runs():
    rng = np.random.default_rng(1)
    tokens, pages = rng.integers(0, 3, 300), np.repeat(np.arange(10), 30)
    tokens[29::30] = -1 - np.arange(10)
    want = np.zeros(300, bool)
    runs = {}
    for i in range(296):
        runs.setdefault(tuple(tokens[i : i + 5]), []).append(i)
    for found in runs.values():
        if len({int(pages[i]) for i in found}) > 1:
            for i in found:
                want[i : i + 5] = True
    assert (html_extract.repeated(tokens, pages, 5) == want).all()


def test_surrogates(spark):
    cipher = surrogates.Cipher(b"k")
    for size in (2, 7, 100):
        images = [cipher.image(i, size, b"t") for i in range(size)]
        assert sorted(images) == list(range(size)) and all(i != x for i, x in enumerate(images))
    text = 'a.1@mail.example.com A.1@MAIL.example.com +1 (555) 123-4567 4111 1111 1111 1111 10.20.30.40 token = "0123456789abcdef0123456789abcdef" Frau Anna Weber, Weber'
    new, counts = surrogates.replace(text, cipher)
    assert counts == {"email": 2, "phone": 1, "card": 1, "ip": 1, "secret": 1, "person": 3}
    first, second = new.split(" ")[:2]
    assert first.lower() == second.lower() and first != "a.1@mail.example.com" and len(new.split("token")[0]) == len(text.split("token")[0])
    card = "".join(new.split(" ")[5:9])  # after two addresses and a number of three words
    assert len(card) == 16 and surrogates.luhn(card[:-1]) == int(card[-1])
    got = surrogates.surrogates(frame(spark, [(1, None), (2, ""), (3, text)])).orderBy("doc_id").collect()
    assert [r["text"] for r in got] == [None, "", surrogates.replace(text, surrogates.Cipher(surrogates.DEFAULT_KEY))[0]]


NAMES = [
    ("Mr McDonald", "McDonald"),
    ("Ms DeLuca", "DeLuca"),
    ("Mr O'Brien's", "O'Brien"),
    ("Mrs Kovačová", "Kovačová"),
    ("Mr Łukasz Nowak", "Łukasz Nowak"),
    ("Dr Yılmaz", "Yılmaz"),
    ("Mr SMITH", "SMITH"),
    ("Mr J. Smith", "J Smith"),
    ("Mr J.R. Smith", "J R Smith"),
    ("Mr van Dijk", "Dijk"),
    ("Mr. John McDonald", "John McDonald"),
    ("Sr. de la Cruz", "Cruz"),
    ("Mr Γιώργος ΠΑΠΑΔΟΠΟΥΛΟΣ", "Γιώργος ΠΑΠΑΔΟΠΟΥΛΟΣ"),
    ("Господин Їжак", "Їжак"),
]


@pytest.mark.parametrize("text,names", NAMES)
def test_surrogate_names(text, names):
    new, counts = surrogates.replace(f"Then {text} left.", surrogates.Cipher(b"k"))
    assert counts == {"person": len(names.split())} and len(new) == len(text) + 11 or "John" in names
    words = "".join(c if c.isalpha() or c in "'" else " " for c in new).split()
    assert not set(names.split()) & set(words)
    assert surrogates.replace("Mr SMITH AND Co", surrogates.Cipher(b"k"))[0].endswith(" AND Co")


def test_surrogate_names_stay_distinct():
    cipher = surrogates.Cipher(b"k")
    for texts in (["ΑΣ", "ΑΤ", "ΑΒ", "ΑΓ", "ΑΔ", "ΑΖ", "ΑΘ", "ΑΚ", "ΑΛ", "ΑΜ", "ΑΝ", "ΑΞ", "ΑΠ", "ΑΡ", "ΑΦ", "ΑΧ", "ΑΨ"], [f"Ñ{c}" for c in "çßøœæñ"], [f"Ĭ{c}" for c in "āăąēıįū"]):
        made = [surrogates.name(cipher, t, "m") for t in texts]
        assert len(set(made)) == len(texts) and all(a != b and [x.isupper() for x in a] == [x.isupper() for x in b] for a, b in zip(texts, made))


def test_licenses(spark):
    mit = "Copyright (c) 2020 Someone\n\n" + licenses._MIT.replace("sublicense", "sub-licence").replace(". ", ".\n")
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, [(1, mit), (2, "x\nReleased under the MIT licence\n"), (3, None), (4, " ")])).collect()}
    assert got[1]["license"] == "MIT" and got[2]["notice_licenses"] == "MIT" and got[2]["license"] is None and got[3]["digest"] is None and got[4]["n_notices"] == 0


def test_licenses_in_any_wrapping(spark):
    import textwrap

    texts = [
        (f"{name}/{width}", "Copyright (c) 2020 Some One\n(c) Anna Two\nCopyright node contributors\n\n" + textwrap.fill(text, width, break_on_hyphens=False, break_long_words=False))
        for name, text in licenses.LICENSES
        if not text.startswith("sha256:")
        for width in (30, 66, 72, 77, 80)
    ]
    texts.append(("ISC/usual", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n" + "copyright notice and this permission notice appear in all copies.\n\n" + licenses._ISC_AS_IS))
    got = licenses.scan(frame(spark, list(enumerate(t for _, t in texts)))).select("doc_id", "license").collect()
    assert {r["doc_id"]: r["license"] for r in got} == {i: n.split("/")[0] for i, (n, _) in enumerate(texts)}
    for line, goes in [("copyright", False), ("(c) you must keep", False), ("copyright law", False), ("copyright [yyyy] [name]", True), ("© x", True), ("# copyright: lawson", True)]:
        assert (licenses.canonical_text(line) == "") == goes


def test_full_licenses_and_frames(spark):
    import hashlib
    from pathlib import Path

    known = licenses.digests(licenses.LICENSES)
    assert {"GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "Apache-2.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense", "Zlib", "BSL-1.0"} <= set(known.values())
    for file, name in [("GPL-3", "GPL-3.0-only"), ("Apache-2.0", "Apache-2.0"), ("MPL-2.0", "MPL-2.0")]:
        path = Path("/usr/share/common-licenses") / file
        if path.exists():
            assert known[hashlib.sha256(licenses.canonical_text(path.read_text()).encode()).hexdigest()] == name
    own = spark.createDataFrame([("X", "Do what\nyou like."), ("Y", "do what you like"), ("Z", None), ("D", "sha256:" + hashlib.sha256(b"digest only").hexdigest())], "name string, text string")
    lines = spark.createDataFrame([("N", "Use it under N."), ("M", "M holds.")], "name string, text string")
    docs = frame(spark, [(1, "Do what you\nlike"), (2, "a\nuse it under n\nM holds.\nUse it under N."), (2, "Digest only!"), (3, None)])
    got = sorted((r["doc_id"], r["license"], r["n_notices"], r["notice_licenses"]) for r in licenses.scan(docs, own, lines).fillna("-", ["license"]).collect())
    assert got == [(1, "X", 0, ""), (2, "-", 3, "M,N"), (2, "D", 0, ""), (3, "-", 0, "")]


def without(spark, rows):
    out = line_dedup.dedup(frame(spark, rows).limit(len(rows)))
    assert out.columns == frame(spark, rows).columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)


def expected(rows):
    """The texts without the lines that brute force removes."""
    gone = line_dedup.brute_force(rows)
    return sorted(((key, None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in g)) for (key, text), g in zip(rows, gone)), key=repr)


def test_line_dedup_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").collect()]
    line = "The quick brown fox jumps over the lazy dog near the old river bank today."
    rows += [(100, line), (101, line.replace("lazy", "lady") + "\n\n" + line), (102, None), (103, "")]
    long_line = words(0, 3_000)  # longer than a block of shingles
    rows += [(104, long_line), (105, long_line.replace("w77 ", "v77 ")), (106, "𝔘𝔫𝔦 " * 12 + "\n" + "é" * 41), (107, "𝔘𝔫𝔦 " * 12 + "!"), (107, "x" * 39 + "\n" + "x" * 39)]
    assert without(spark, rows) == expected(rows)


def test_line_dedup_short_lines(spark):
    rows = [(1, "abc\nabcd\nabcde"), (2, "abcdef\nabc"), (3, "La leretion elle èan aioi."), (4, "En leretion elle èan aioi.\n" + "x y " * 9 + "end"), (5, "x y " * 9 + "end!\nhello word one"), (6, "hello word one.\nhello")]
    assert without(spark, rows) == expected(rows)
    assert dict(zip((r[0] for r in rows), line_dedup.brute_force(rows))) == {1: [], 2: [1], 3: [], 4: [0], 5: [0], 6: [0]}


def test_line_dedup_rows_of_one_id(spark):
    """Rows are told apart by id and text: a line goes from the row that it is a copy in, from no other."""
    twice = "A line that is found in two of these documents."
    rows = [(1, twice + "\nfirst"), (2, "own line of the one row\n" + twice), (2, "own line of the other row\nthat must stay as it is"), (None, twice), (None, "only here, without an id"), (3, "equal rows"), (3, "equal rows"), (4, None)]
    got = without(spark, rows)
    assert got == expected(rows)
    assert (2, "own line of the other row\nthat must stay as it is") in got and (2, "own line of the one row") in got and (None, "") not in got
    assert without(spark, [])  == []


def test_line_signatures():
    rng = np.random.default_rng(3)
    lines = ["".join(rng.choice(list("abcdef "), n)) for n in (5, 40, 2_047, 2_060, 70_000, 41)]
    assert (line_dedup.signatures(lines) == np.concatenate([line_dedup.signatures([x]) for x in lines])).all()
    assert line_dedup.signatures([]).shape == (0, 96) and line_dedup.most_differing(80) == 33


def test_mixing_equal_rows(spark):
    """Rows that nothing tells apart are counted one by one, with and without an id."""
    for rows in ([(7, words(0, 10))] * 100, [(None, words(0, 10))] * 100, [(i % 3, words(0, 10)) for i in range(100)]):
        got = mixing.mix(frame(spark, rows)).collect()
        assert len(got) == 100 and sum(r["size"] * r["copies"] for r in got) == 1_500 and got[0]["target"] == 1_500 and max(r["copies"] for r in got) == 2


def test_clashing_columns_stay(spark):
    """Columns named like those that the operators make or use come back as they were given."""
    names = ["n_words", "spans", "items", "kept", "clean_text", "_judged", "_judge_words", "size", "copies", "target", "source_size"]
    text = " ".join(f"Every{i} sentence{i} is its own." for i in range(20))
    docs = spark.createDataFrame([(i, text.replace("own", f"own{i}"), "s", 1, *[f"mine {i}"] * len(names)) for i in range(4)], "doc_id long, text string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([("a", "nothing of this is there")], "item_id string, text string")
    cleaned = decontaminate.remove(docs, items)
    for out in (cleaned, quality_rules.stage(spark, docs.drop("_judge_words"), SF), mixing.stage(spark, docs, SF)):
        assert out.columns == [c for c in docs.columns if c in out.columns] and len(out.columns) >= len(docs.columns) - 1
        rows = out.collect()
        assert rows and all(r[n] == f"mine {r['doc_id']}" for r in rows for n in names if n in out.columns)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.materialise(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count() > 0
