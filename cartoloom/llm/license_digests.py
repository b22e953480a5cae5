"""Digests of the canonical forms of full licence texts, as ``licenses.canonical_text`` makes them.

Texts of one licence differ: with and without the appendix on how to apply it, and with each address of the Free Software
Foundation. A change of the canonical form needs new digests. The GNU texts are the same for "only" and "or later".
"""

# SPDX identifier and digest.
DIGESTS = [
    ("Apache-2.0", "37aa90548985ac0057637d42c3153e8b5d107a21d9556d7fbe60e3e426fdacaa"),
    ("Apache-2.0", "9ce71eb31a8abf79414c431def165019f9604548c79edc94fe0d7d50b2f8703e"),
    ("Apache-2.0", "dbb777d3ad1fb948fbe99e6748cbd3fea3f269381f3f7efe3f4259a28a9269c9"),
    ("BSL-1.0", "5fcf89bde8c0c2deb999f4cc626e1aebf90e80fdc5cd334dae008152ef4a1ded"),
    ("CC-BY-SA-4.0", "e7ab2c95c0a583681fcc0e8ff5768f05516480e7a144b8009451c871267661d1"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2-only", "774142f7f9d180b719ac1fe23dfba3589d91276d948e4dd116cb8811cec60691"),
    ("GFDL-1.2-only", "915561db8eb69b9193eeb710593d298365e0c52787feb731c684977d5b417af7"),
    ("GFDL-1.2-only", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3-only", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0-only", "2360a1b8fc5b5a8b1db5f560a193fbbc23ee8a553de375a1c8fcc5805d683848"),
    ("GPL-1.0-only", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0-only", "7b86297a2762700b078231c8b488809b0f63cac5e298d74f4270d251bbef230f"),
    ("GPL-1.0-only", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-1.0-only", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0-only", "98c96304603be152968c123e484f744c9b51ebd341914aee6eea5c39133891e1"),
    ("GPL-1.0-only", "a87d2335c7c408f93c15dd6892a723a61b2645ff1ad65619233239cce6bd570d"),
    ("GPL-1.0-only", "ac9f80a0d38a1e001427acb1e9fa5f9a23aee35e40ee2759901306fd4e382697"),
    ("GPL-1.0-only", "c0734228e33375b72256fed50d8056b50049dff71f408765af98cd4384a7434a"),
    ("GPL-2.0-only", "031ce0347a7bfaa9fea9fb34dc0def0f70d366e9b6aeab50cf9537178d0d9d50"),
    ("GPL-2.0-only", "1188bd946c8b086fe6ea384131bc5e4725728e74e0fe1902762c9c87ec4bd36a"),
    ("GPL-2.0-only", "204354f4ce2c7d402ca9ad1c08c91b4301b495a0769207c9817a1e1536f3dab2"),
    ("GPL-2.0-only", "2d5106d375402f83b041785ad1b9925ed45196d448c7db5889cf8d50aece384b"),
    ("GPL-2.0-only", "2dddfb21baee920dbbc3d75228da3d2104eb54e673ef5f867ab4495e23c974fc"),
    ("GPL-2.0-only", "58f387b55eb95a9c5a6ef16e9064e1bfa9420a69181c677ee6eddf6ed1397cfd"),
    ("GPL-2.0-only", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-2.0-only", "765649880cdff92fe5ac36da2f80c5d70533878beda24dba289f983bd3913453"),
    ("GPL-2.0-only", "78e9c9f811bd1ba04ed6d619d3e51a759305d2f124cee9defa3535ba4a24bd25"),
    ("GPL-2.0-only", "8c1c2994cc30a83607e645d0c7bfe94908618dbc8797ce927cf2fe8ebf674752"),
    ("GPL-2.0-only", "9bd057847abcffd3f15185fad140e3672c126a542d4849381ab82e33384d56a1"),
    ("GPL-2.0-only", "aa997bc1c3422ccdc7ccabdc6f9aaa9ce2ebeed7be208887d2b13ff901326c75"),
    ("GPL-2.0-only", "acaf68e303fe7610fff5b930bace57b87821d132bc434f4a104512da48f8bb6c"),
    ("GPL-2.0-only", "b1abfb46077acd6c0450274e16fe4cb4610ec546c090c5977a069c5f74340774"),
    ("GPL-2.0-only", "ba8b5323b72bf2f2c5d07074133b38292e0fa23fde8fa48771ba8a04cccacddd"),
    ("GPL-2.0-only", "c2eea7a9d82a254e540a96d8107801d93d00bcef2742a78b7e8e8d0c0efcbd1c"),
    ("GPL-2.0-only", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0-only", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0-only", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("GPL-3.0-only", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0-only", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0-only", "084782a05c82d5e85c704f06bab601971e84b3b9b90a51c95ffcff2b342d9cf2"),
    ("LGPL-2.0-only", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.0-only", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0-only", "5ce88337a2fce97b0f2b6aac63afc49927c0dc31e15bf530a83e603e1d298d8b"),
    ("LGPL-2.0-only", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0-only", "cbc927caf696ef44b2fbebe29ffa45a5fccf0a64c78f2b85678a11032ebb3318"),
    ("LGPL-2.0-only", "d40504a2bf1a1a86ee76e642ced31126577d21774b1ac0a222ce730ec78d7108"),
    ("LGPL-2.0-only", "dc842683831d008ff5f32600206cfd765e4d05df71fe831b1b4b31462fa2fff1"),
    ("LGPL-2.0-only", "feb45efa998ac9d6ca85b1b2b7dfb124a14b1e88f579d2de38fe3a7970ce7380"),
    ("LGPL-2.1-only", "0de2e3ba00ed5f309ce9d71663e50ea414063f6e46865f2d80d4ad038f268c87"),
    ("LGPL-2.1-only", "3bde1ca18489d8594a2c0c04b5ae1003c1795d1680675f4ef758325e1e1c3169"),
    ("LGPL-2.1-only", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1-only", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1-only", "925c28788af11361f32b5b10dbeb4454be64e8448ed4a7c0926618a5d8a85bfb"),
    ("LGPL-2.1-only", "a5ac783c64dc7fa3fe7b641692ee7b8da491bd87f613c9bb99618a9469e71c47"),
    ("LGPL-2.1-only", "bd06b7347431b0fc243c0e32d1668ab362329b4a591386570abd310334f6fbdb"),
    ("LGPL-2.1-only", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-2.1-only", "df8b7d554d9ba4683d95046dc0cd8fdf6c063841a3cfabcf242ab40e69237421"),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "dca4c975ceb5ed80ec4b97c7ae03c9f0723ade327cf297a7e745f117af15b9d3"),
    ("MPL-2.0", "2ae5d4417f09cff2e3412d0e35c4ee2439f6c18ca69d7d9cc799b33614c368a5"),
    ("OFL-1.1", "b80f6498cf31cc02c16942b317f9b5b55be820889a29c0a2c97a9e41a7b4eb07"),
    ("Unicode-3.0", "53113a39b79251016cf92b8348f303cee44e4faee1f232536754abc669dd32c8"),
    ("Unlicense", "e004e218cb49cc5380ae88b74959546d5ffade35d8fa0f2d1fe2c87f91a33b89"),
    ("Unlicense", "e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229"),
    ("Zlib", "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7"),
    ("Zlib", "99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a"),
    ("Zlib", "ee37bc3ccba61ff28a10c05f28bdabf7466db400a75d9a1890fb865cda23e145"),
]
