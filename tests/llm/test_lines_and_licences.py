import re

import xxhash
from conftest_llm import passage, sentence, words
from pyspark.sql import functions as F

from notewright.llm import license_scan, line_dedup


def without_repeats_by_hand(rows, least):
    """All lines of any run of `least` words that stands at an earlier place, by trying every run."""
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0))
    seen, gone = {}, {}
    for r in order:
        lines = [tuple(x.split()) for x in (rows[r][1] or "").split("\n") if x.split()]
        gone[r] = set()
        for start in range(len(lines)):
            for end in range(start + 1, len(lines) + 1):
                run = tuple(lines[start:end])
                if sum(map(len, run)) >= least:
                    if seen.setdefault(run, (r, start)) != (r, start):
                        gone[r].update(range(start, end))
    out = []
    for r, (i, text) in enumerate(rows):
        kept, n = [], 0
        for line in (text or "").split("\n"):
            if line.split():
                if n not in gone[r]:
                    kept.append(line)
                n += 1
            else:
                kept.append(line)
        out.append((i, None if text is None else "\n".join(kept), n, len(gone[r])))
    return out


def line_rows():
    shared, short, run = sentence("shared", 60), sentence("short", 9), [sentence(f"run{i}", 15) for i in range(6)]
    return [
        (1, f"{short}\n{sentence('a')}\n{shared}"), (2, f"{sentence('b')}\n{short}\n\n{shared}\n{short}"),
        (3, "\n".join([sentence("c"), *run, sentence("d")])),
        (4, "\n".join([sentence("e"), *run[1:], sentence("f"), *run[:4]])),
        (5, "\n".join(run[:3])), (6, "\n".join(["twice", *run[2:], *run[2:]])), (7, shared.replace(" ", "  ")),
        (8, "\n".join(["Same line here."] * 60)), (9, None), (10, ""), (11, " \n\n"), (0, "\n".join(run[3:5])),
        (12, sentence("last", 49)), (13, sentence("last", 49)), (14, " ".join(words("x", 5000))),
        (15, " ".join(words("x", 5000))),
    ]


def test_repeated_runs_against_all_runs(documents):
    rows = line_rows()
    docs = documents(rows).withColumn("runs", F.lit(1)).withColumn("_doc", F.lit(2)).withColumn("N_lines", F.lit(3))
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.drop("N_lines").columns + ["n_lines", "n_removed", "words_removed"]
    found = sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect())
    assert sorted(found, key=str) == sorted(without_repeats_by_hand(rows, 50), key=str)


def test_odd_rows_keep_their_number_and_columns(documents, odd_rows):
    out = line_dedup.drop_repeated_lines(documents(odd_rows)).collect()
    assert len(out) == len(odd_rows)
    twice = [r.text for r in out if r.doc_id == 4]
    # rows of one id and text are one document; a second text of the id and a later copy are not
    assert twice.count(passage("x")) == 0 or twice.count(passage("x")) == 2
    assert [r.text for r in out if r.doc_id == 9] == [t for i, t in odd_rows if i == 9]
    assert line_dedup.drop_repeated_lines(documents([])).count() == 0


def test_windows_hold_the_least_number_of_words():
    text = "\n".join(sentence(i, n) for i, n in enumerate([10, 45, 3, 3, 60, 20, 20, 20])).encode()
    size = [10, 45, 3, 3, 60, 20, 20, 20]
    windows = line_dedup.windows_of(text, 50)
    found = {(start, end) for _, _, start, end, _ in windows}
    onward = {(i, next((e for e in range(i, 8) if sum(size[i:e + 1]) >= 50), None)) for i in range(8)}
    backward = {(next((i for i in range(e, -1, -1) if sum(size[i:e + 1]) >= 50), None), e) for e in range(8)}
    assert found == {(i, e) for i, e in onward | backward if i is not None and e is not None}
    line = [xxhash.xxh64_intdigest(x) for x in text.split(b"\n")]
    signed = [x - (1 << 64) if x >> 63 else x for x in line]
    for position, value, start, end, _ in windows:
        assert value == min(signed[start:end + 1]) == signed[position] and value not in signed[start:position]


def test_fingerprints_are_fewer_than_lines_and_shared_by_repeated_runs(documents):
    run = [sentence(f"r{i}", 10) for i in range(40)]
    texts = [[sentence(f"{t}/{i}", 10) for i in range(200)] for t in range(4)]
    texts[1][50:90], texts[3][7:47] = run, run
    docs = documents([(i, "\n".join(t)) for i, t in enumerate(texts)])
    selected = [(r.doc.doc_id, r.position) for r in line_dedup.fingerprints(docs, 50).collect()]
    assert len(selected) == len(set(selected))
    # windows of 5 lines select about 2 of 6 lines, windows that end short of 50 words a few more
    assert 800 / 5 <= len(selected) < 800 / 2
    inside = lambda doc, at: {p - at for d, p in selected if d == doc and at + 4 <= p < at + 36}
    assert inside(1, 50) == inside(3, 7) != set()


def test_matches_extend_to_whole_runs(documents):
    run = [sentence(f"r{i}", 10) for i in range(30)]
    texts = [[sentence(f"{t}/{i}", 10) for i in range(60)] for t in range(3)]
    texts[0][10:40], texts[2][5:35] = run, run
    texts[1][0:8] = run[:8]  # a shorter one between
    texts[2][40:46] = run[24:]
    found = line_dedup.repeated_runs(documents([(i, "\n".join(t)) for i, t in enumerate(texts)])).collect()
    assert sorted((r.doc.doc_id, r.source.doc_id, r.start, r.end, r.source_start) for r in found) == [
        (1, 0, 0, 7, 10), (2, 0, 5, 34, 10), (2, 0, 40, 45, 34)]


def test_lines_selected_once_list_no_windows(documents):
    rows = [(i, "\n".join([sentence(f"{i}/{k}", 20) for k in range(30)])) for i in range(30)]
    assert line_dedup.matches(documents(rows)).count() == 0
    often = "The same short line."
    rows = [(i, "\n".join(x for k in range(20) for x in (often, sentence(f"{i}/{k}", 20)))) for i in range(30)]
    assert line_dedup.matches(documents(rows)).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def licences_by_hand(rows):
    out = []
    for i, text in rows:
        low = (text or "").translate(LOWER)
        found = WORD.findall(low)
        places = [
            (k, label) for k in range(len(found)) for phrase, label in license_scan.PHRASES.items()
            if found[k:k + len(phrase.split())] == phrase.split()]
        base = sorted({label for _, label in places})
        best, own = 0.0, set()
        for label, template in license_scan.TEMPLATES.items():
            stated = WORD.findall(template.translate(LOWER))
            wanted, span = set(stated), 2 * len(stated)
            for k in range(len(found)):
                share = len(wanted & set(found[k:k + span])) / len(wanted)
                if share >= license_scan.THRESHOLD:
                    own.add(label)
                    best = max(best, share)
        out.append((
            i, len(found), len(places), min((k for k, _ in places), default=None),
            max((k for k, _ in places), default=None), ",".join(base), ",".join(sorted(own | set(base))),
            1.0 if places else best))
    return sorted(out, key=str)


def test_licences_against_every_block_and_template(documents, odd_rows):
    rows = odd_rows + [
        (30, "Text.\nLicensed under CC BY-NC 4.0.\nMore"), (31, "released UNDER the mit LICENSE"),
        (32, "All\nrights\nreserved, all rights reserved"), (33, "Licensed under the\nApache License, Version 2.0"),
        (34, "Licensed under the Apache License Version 2"), (35, "licensed under the apache"),
        (36, "İ cc by × CC-BY a" + " general public license" * 3), (37, "version 3 license public general gnu"),
        (38, "This work is licensed under the GNU General Public License, version 3 and the MIT License, released"),
        (39, "cc0 x the of author has waived all copyright to possible under law extent"),
        (None, "Released under the MIT License."), (40, "ccbycc by"),
        (41, "Redistribution and use in source and binary\nforms, with or without\n * modification, are permitted"),
        (42, "released " + "far " * 9 + "under the MIT license"), (43, "far " * 30 + "Released\n\nunder the\nMIT\nLicense"),
        (44, "Released under the MIT License. " * 400), (45, "the under license mit " + "the " * 3000),
    ]
    docs = documents(rows).withColumn("low", F.lit("cc by")).withColumn("label", F.lit("x")).withColumn("words", F.lit(1))
    found = license_scan.scan_licences(docs)
    assert sorted(map(tuple, found.collect()), key=str) == licences_by_hand(rows)
    assert license_scan.scan_licences(documents([])).count() == 0


def test_wrapped_notices_are_found(documents):
    rows = [
        (1, "Licensed under the\nApache License,\nVersion 2.0"),
        (2, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"),
        (3, "This work is\nlicensed under a Creative\nCommons Attribution 4.0\nLicense"), (4, "Licensed under the\nsun"),
    ]
    found = license_scan.scan_licences(documents(rows)).orderBy("doc_id").collect()
    assert [(r.labels, r.score) for r in found] == [("apache-2.0", 1.0), ("bsd", 1.0), ("cc-by-4.0", 1.0), ("", 0.0)]


def test_repeated_words_of_a_template_have_room(documents):
    found = license_scan.scan_licences(
        documents([(1, "free free free as beer"), (2, "free as beer")]), {"x y": "xy"},
        {"f": "free free free as beer"}, threshold=1.0).orderBy("doc_id").collect()
    assert [r.labels for r in found] == ["f", "f"]


def test_own_phrases_and_templates(documents):
    rows = [(1, "free as in beer"), (2, "beer in the free world")]
    found = license_scan.scan_licences(
        documents(rows), {"as in": "like"}, {"beer": "free beer"}, threshold=1.0).orderBy("doc_id").collect()
    assert [(r.base_labels, r.labels, r.score) for r in found] == [("like", "beer,like", 1.0), ("", "beer", 1.0)]
