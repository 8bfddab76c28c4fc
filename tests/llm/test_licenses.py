"""License scans on given wordings, changed ones and odd input."""

from clickloom.llm import licenses
from clickloom.llm.licenses import TEMPLATES

MIT, BSD = TEMPLATES["MIT"][1], TEMPLATES["BSD-2-Clause"][0]


def test_every_template_is_found_as_itself(rows):
    texts = [(f"{name}/{i}", f"Some words before.\n{w}.\nThe end of it.") for name, ws in TEMPLATES.items() for i, w in enumerate(ws)]
    for r in licenses.scan_licenses(rows(texts, "doc_id string, text string")).collect():
        assert [(x.license, x.verdict) for x in r.licenses] == [(r.doc_id.split("/")[0], "exact")], r.doc_id


def test_wording_differences_long_lines_and_odd_texts(rows):
    changed = MIT.replace("free of charge", "for no charge").replace("sublicense, ", "")
    texts = [None, "", "no rights here", "You need a licence fee and a license plate.", changed, "word " * 50_000 + ". " + MIT + " " + "tail. " * 20_000, "x\n" + BSD, "same. " + MIT, "same. " + MIT]
    df = rows([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, licenses int")
    out = {r.doc_id: r.licenses for r in licenses.scan_licenses(df).collect()}
    assert out[0] == out[1] == out[2] == []
    assert [x.verdict for x in out[3]] == ["mention"]
    assert [(x.license, x.verdict) for x in out[4]] == [("MIT", "modified")]
    assert "sublicense" in out[4][0].missing and out[4][0].extra == ["for", "no"]
    for i in (5, 7, 8):
        assert [(x.license, x.verdict) for x in out[i]] == [("MIT", "exact")]
        assert texts[i][out[i][0].start : out[i][0].end].strip().endswith("of the Software.")
    assert [(x.license, x.verdict) for x in out[6]] == [("BSD-2-Clause", "exact")]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_compression_ranks_the_right_template_among_the_first():
    scanner = licenses.Scanner(TEMPLATES)
    for name, wordings in TEMPLATES.items():
        for w in wordings:
            first = scanner.rank(licenses.words(w))[: licenses.CONFIRMED]
            assert name in {scanner.templates[i][0] for _, i in first} and first[0][0] > 0.2


def test_short_wordings_in_prose_and_several_in_a_block():
    scanner = licenses.Scanner(TEMPLATES)
    prose = "the material below was gathered by any person for the following purposes, subject to notice and conditions, without limitation of use or any changes in copies of the work "
    for wording, name in (("Released under the MIT License", "MIT"), ("All rights reserved", "proprietary")):
        text = prose + wording + " in all, including the right to publish, modify and distribute the software, and portions of it that are available under other terms in the file"
        (found,) = scanner.judge(text)
        assert (found["license"], found["verdict"], text[found["start"] : found["end"]]) == (name, "exact", wording)
    text = "Copyright 2020 A. Writer\n" + MIT + "\n" + BSD + "\nReleased under the MIT License. All rights reserved.\nReleased under the MIT License."
    found = scanner.judge(text)
    assert [(x["license"], x["verdict"]) for x in found] == [(None, "mention"), ("MIT", "exact"), ("BSD-2-Clause", "exact"), ("MIT", "exact"), ("proprietary", "exact"), ("MIT", "exact")]
    assert all(x["end"] <= y["start"] for x, y in zip(found, found[1:]))
    changed = TEMPLATES["Apache-2.0"][1].replace("express or implied", "implied") + "\n" + BSD.replace("are met", "are all met")
    assert [(x["license"], x["verdict"]) for x in scanner.judge(changed)] == [("Apache-2.0", "modified"), ("BSD-2-Clause", "modified")]
    wide = MIT.replace("to deal in", "the river runs slowly past old mills and quiet gardens " * 8 + "to deal in")
    assert [(x["license"], x["verdict"]) for x in scanner.judge(wide)] == [("MIT", "modified")]
