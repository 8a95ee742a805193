from pyspark.sql import functions as F

from vitrine.llm import licence as L

SCHEMA = "doc_id long, text string, digest string"


def test_whole_texts_and_notices(frame):
    mit = "The MIT Licence (MIT)\n\nCopyright (c) 2020 Someone\nAll rights reserved.\n\n" + L._MIT.upper().replace("LICENSE", "LICENCE").replace(",", " ,")
    rows = [(1, mit, "c"), (1, mit, "c"), (2, L._MIT + " and more", None), (3, "text\n  Released under the MIT Licence!\nmore", None),
            (4, "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.", None),
            (5, None, None), (6, "", "c"), (None, "Released under the MIT License.", None), (7, "word " * 400_000, None),
            (8, "Copyright 1999 x", None)]
    got = L.scan(frame(rows, SCHEMA).repartition(3))
    assert got.columns == ["doc_id", "digest", "license_id", "notices", "n_notice_lines"] and got.count() == 10
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].license_id == "MIT" and by[2].license_id is None
    assert (by[3].notices, by[3].n_notice_lines) == ("MIT", 1) and by[4].notices == "CC-BY-NC-4.0,GPL-3.0"
    assert by[5].digest is None and by[6].notices == "" and by[None].notices == "" and by[8].digest == by[6].digest
    assert L.scan(frame([], SCHEMA)).count() == 0


def test_every_notice_holds_the_word():
    assert all(L.NOTICE_WORD in t.lower() for _, t in L.NOTICES)


def test_spellings_fix_adjacent_words(spark, frame):
    got = frame([("licence licence owner",), ("LICENSE license, holder",)], "t string").select(L.digest(F.col("t")).alias("d"))
    assert len({r.d for r in got.collect()}) == 1


def test_plan_has_no_python(frame):
    plan = L.scan(frame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_whole_texts_at_any_line_width(frame):
    import textwrap

    rows, want = [], {}
    heads = ["Copyright (c) 2020 Someone\nAll rights reserved.\n\n", "Copyright 2001-2019 The Authors\n", "(c) 1999 Someone\n", "COPYRIGHT The Regents\n", ""]
    for i, (name, known) in enumerate(L.LICENCES):
        for width in (40, 60, 66, 72, 79, 100, 100_000):
            body = "\n".join(textwrap.fill(" ".join(p.split()), width) for p in known.split("\n\n"))
            rows.append((len(rows), heads[i % len(heads)] + body, None))
            want[len(rows) - 1] = name
    for word in ("notice", "holder", "holders", "owner"):  # wrapped just before the word
        for name, known in L.LICENCES:
            rows.append((len(rows), known.replace(f" copyright {word}", f"\ncopyright {word}").replace(f" COPYRIGHT {word.upper()}", f"\nCOPYRIGHT {word.upper()}"), None))
            want[len(rows) - 1] = name
    got = {r.doc_id: r.license_id for r in L.scan(frame(rows, SCHEMA)).collect()}
    assert got == want
