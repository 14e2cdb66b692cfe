"""Lines that look like a license notice but name another license."""

from depthmill.llm import licenses

OTHERS = [
    "Released under the BSD License.",
    "Licensed under CC BY-SA 4.0.",
    "This work is licensed under the GNU General Public License, version 2.",
    "This work is licensed under the GNU Lesser General Public License, version 3.",
    "Released under the words of the far " + "away " * 5000 + "MIT License.",
    "Permission is hereby granted, free of charge " + "and then something else " * 60 + " to any person",
]


def test_look_alike_lines_match_nothing(spark):
    frame = spark.createDataFrame(list(enumerate(OTHERS)), "doc_id long, text string")
    assert licenses.licensed(frame).collect() == []


def test_matched_words_stand_close(spark):
    words = licenses.TEMPLATES["ISC"].split()
    far = (" gap" * 500 + " ").join([" ".join(words[:16]), " ".join(words[16:])])
    frame = spark.createDataFrame([(1, far), (2, " ".join(words[:16] + ["gap"] + words[17:]))], "doc_id long, text string")
    assert [(r.doc_id, r.license) for r in licenses.licensed(frame).collect()] == [(2, "ISC")]


def test_whole_notices_are_found(spark):
    rows = [(k, f"some text, {t} and more") for k, t in enumerate(licenses.TEMPLATES.values())]
    found = {(r.doc_id, r.license, r.coverage) for r in licenses.licensed(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found >= {(k, name, 1.0) for k, name in enumerate(licenses.TEMPLATES)}
