import re

from zonalspark.llm import license_scan as ls


def test_every_template_wins_its_own_text():
    scanner = ls.Scanner(ls.TEMPLATES)
    for name, text in ls.TEMPLATES.items():
        want = name.removesuffix("-short").removesuffix("-long")
        assert scanner.scan(text)["license"] == want
        got = scanner.scan("Some words. " + text + " (c) 2020 Someone Else")
        assert got["license"] == want and got["wording"] == 1 and got["missing"] == []


def test_wording_differences():
    scanner = ls.Scanner(ls.TEMPLATES)
    got = scanner.scan(ls.TEMPLATES["MIT"].replace("free of charge", "free of any charge").replace("hereby ", ""))
    assert (got["license"], got["missing"], got["between"]) == ("MIT", ["hereby"], ["any"])
    assert scanner.scan("This licence says nothing that any template says.")["license"] == "unknown"
    assert scanner.scan("Licensed under CC BY-ND 4.0.")["license"] != "CC-BY-NC-4.0"


def test_scan(spark):
    mit = ls.TEMPLATES["MIT"].replace(", ", ",\n")
    rows = [(1, "é word\nReleased under the MIT License.\n\nmore"), (2, None), (3, ""), (4, "a b " * 9000), (5, "x\n" + mit), (5, "x\n" + mit), (None, "All rights reserved.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", ls.F.lit("z"))
    got = sorted((r["doc_id"] or 0, r["start"], r["license"]) for r in ls.scan(docs).collect())
    assert got[:2] == [(0, 0, "all-rights-reserved"), (1, 7, "MIT")]
    assert ls.scan(docs.limit(0)).count() == 0
    assert ls.blocks("a\nlicense\nb\ncopyright\n\nx", re.compile(ls.CUE)) == [(2, "license\nb\ncopyright")]


WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.""",
}
WRAPPED["BSD-3-Clause"] = (
    WRAPPED["BSD-2-Clause"]
    + """

3. Neither the name of Example Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
)


def test_wrapped_headers(spark):
    marks = ["", "# ", " * ", "// "]
    rows = [(f"{name} {k}", "\n".join(mark + line for line in ["def one(): pass", "", *text.split("\n"), "", "word and word"])) for name, text in WRAPPED.items() for k, mark in enumerate(marks)]
    got = sorted((r["doc_id"], r["license"]) for r in ls.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect())
    assert got == sorted((i, i.split()[0]) for i, _ in rows)


def test_every_licence_of_a_text():
    scanner = ls.Scanner(ls.TEMPLATES)
    text = "\n".join(["Copyright 2020 Someone. All rights reserved.", *WRAPPED.values(), "word", WRAPPED["MIT"], "Licensed under CC BY-SA 4.0."])
    got = scanner.confirmed("é " * 3000 + text + " the copy" * 3000)
    assert [x["license"] for _, _, x in got] == ["all-rights-reserved", *WRAPPED, "MIT", "CC-BY-SA-4.0"]
    assert all(b <= c for (_, b, _), (c, _, _) in zip(got, got[1:]))


def test_prose_is_no_block_and_long_lines_are_cut_near_the_word(spark):
    cue = re.compile(ls.CUE)
    assert ls.blocks("it was as is well known, under these conditions two copies and a notice; a licentious man, (c) and so on", cue) == []
    words = " word" * 3000
    text = "head" + words + " some license of ours" + words
    [(start, block)] = ls.blocks(text, cue)
    assert text[start : start + len(block)] == block and "some license of ours" in block and len(block) < 3 * ls.REACH
    two = ls.blocks("license" + words + " copyrighted" + words + "\nlicense next", cue)
    assert [b.split()[0] for _, b in two[:1]] == ["license"] and len(two) == 3 and two[2][1] == "license next"
    docs = spark.createDataFrame([(1, words + " " + ls.TEMPLATES["MIT"] + words + " a warranty of some kind" + words)], "doc_id long, text string")
    got = sorted((r["start"], r["license"]) for r in ls.scan(docs).collect())
    assert got[0] == (len(words) + 1, "MIT") and got[1][1] == "unknown" and len(got) == 2


def brute_align(template, own):
    """Most template words in order, less those missing and in between, over every stretch of own."""
    best = 0
    for i in range(len(own)):
        row = [0] + [-k for k in range(1, len(template) + 1)]
        for b in range(i, len(own)):
            new = [row[0] - 1]
            for a in range(1, len(template) + 1):
                new.append(max(row[a] - 1, new[a - 1] - 1, row[a - 1] + 1 if own[b] == template[a - 1] else -(10**6)))
            row = new
            best = max(best, row[-1])
    return best


def test_alignment_against_brute_force():
    import random

    rng = random.Random(7)
    for _ in range(150):
        template, own = ([rng.randrange(5) for _ in range(rng.randrange(1, n))] for n in (8, 14))
        pairs = ls.align(ls.np.array(template), ls.np.array(own))
        assert all(template[a] == own[b] for a, b in pairs) and pairs == sorted(pairs)
        missing, between = len(template) - len(pairs), (pairs[-1][1] - pairs[0][1] + 1 - len(pairs)) if pairs else 0
        if pairs:
            assert len(pairs) - missing - between == brute_align(template, own) or brute_align(template, own) <= 0


def test_reductions_are_those_of_raw_dictionaries():
    import zstandard

    scanner = ls.Scanner(ls.TEMPLATES)
    block = ls.TEMPLATES["ISC"] + " and more"
    alone = len(zstandard.ZstdCompressor(level=3).compress(block.encode()))
    for (name, text), saved in zip(ls.TEMPLATES.items(), scanner.reductions(block)):
        raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        assert saved == 1 - len(zstandard.ZstdCompressor(level=3, dict_data=raw).compress(block.encode())) / alone, name
    assert scanner.unknown(block)["template"] == "ISC"


def test_the_ranking_decides(monkeypatch):
    """GPL and AGPL notices differ in a word, so either wording is confirmed: the one that saves more wins, and another ranking another one."""
    scanner = ls.Scanner(ls.TEMPLATES)
    text = "Head of a file.\n" + WRAPPED["GPL-3.0"]
    assert [x["license"] for _, _, x in scanner.confirmed(text)] == ["GPL-3.0"]
    other, plain = scanner.names.index("AGPL-3.0"), ls.Scanner.reductions

    def turned(self, block):
        out = plain(self, block)
        out[other] = out.max() + 0.01
        return out

    monkeypatch.setattr(ls.Scanner, "reductions", turned)
    assert [(x["license"], x["missing"], x["between"]) for _, _, x in scanner.confirmed(text)] == [("AGPL-3.0", ["affero"], [])]
    # a top rank without the wording is passed over
    other = scanner.names.index("Unlicense")
    assert [x["license"] for _, _, x in scanner.confirmed(text)] == ["GPL-3.0"]


def test_every_block_is_compressed_with_every_template(monkeypatch):
    seen, plain = [], ls.Scanner.reductions
    monkeypatch.setattr(ls.Scanner, "reductions", lambda self, block: seen.append(block) or plain(self, block))
    scanner = ls.Scanner(ls.TEMPLATES)
    aligned, align = [], ls.align
    monkeypatch.setattr(ls, "align", lambda template, own: aligned.append(len(seen)) or align(template, own))
    assert scanner.confirmed("x " * 50 + WRAPPED["MIT"])[0][2]["license"] == "MIT"
    assert seen and min(aligned) > 0  # nothing is aligned before its block was ranked


def test_full_texts_are_found_whole(spark):
    import random

    rng = random.Random(4)
    texts = ls.full_texts()
    assert {"Apache-2.0-text", "GPL-3.0-text", "MPL-2.0-text"} <= set(texts)
    rows, want = [], {}
    for i, (name, text) in enumerate(texts.items()):
        own = text.split()
        for _ in range(len(own) // 60):  # a word changed, lost or new now and then
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice([[], ["other"], [own[at], "more"]])
        rows.append((i, "prose before it " * 30 + "\n" + (text if i % 2 else " ".join(own)) + "\nprose after it " * 30))
        want[i] = name.removesuffix("-text")
    got = ls.scan(spark.createDataFrame(rows, "doc_id long, text string")).filter("template like '%-text'").collect()
    assert {r["doc_id"]: r["license"] for r in got} == want and len(got) == len(want)
    for r in got:
        assert r["length"] > 0.95 * len(" ".join(texts[r["template"]].split())) and (r["wording"] == 1) == (r["doc_id"] % 2 == 1)


def test_alignment_in_halves_is_as_good(monkeypatch):
    import random

    rng = random.Random(9)
    for _ in range(100):
        template, own = (ls.np.array([rng.randrange(6) for _ in range(rng.randrange(1, n))]) for n in (30, 50))
        monkeypatch.setattr(ls, "CELLS", 1 << 22)
        whole = ls.align(template, own)
        monkeypatch.setattr(ls, "CELLS", 40)
        parts = ls.align(template, own)
        assert parts == sorted(set(parts)) and all(template[a] == own[b] for a, b in parts)
        score = lambda pairs: len(pairs) - (len(template) - len(pairs)) - ((pairs[-1][1] - pairs[0][1] + 1 - len(pairs)) if pairs else 0)
        assert score(parts) == score(whole)


def test_long_unknown_blocks_are_ranked_by_windows():
    scanner = ls.Scanner(ls.TEMPLATES | ls.full_texts())
    filler = "a license of ours that says little and lasts long\n" * 400
    head = " ".join(ls.full_texts()["Apache-2.0-text"].split()[:500])
    got = scanner.unknown(filler + head + "\n" + filler)
    assert (got["license"], got["template"]) == ("unknown", "Apache-2.0-text") and got["reduction"] > 0.3
    assert len(got["missing"]) + len(got["between"]) < 3000
