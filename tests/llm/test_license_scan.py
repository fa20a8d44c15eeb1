"""Licence scan against a plain scan with Python's re."""

import re

from rentlens.llm.license_rules import BASE_PHRASES, build_rules
from rentlens.llm.license_scan import license_report, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

TEXTS = [
    None, "", " \n", "Übung macht den Meister",
    "Released under the MIT License. mit license MIT-License mit license",
    "Licensed under CC BY-NC 4.0. and again cc by", "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0 (the License)", "SPDX-License-Identifier: MPL 2.0",
    "BSD 3-Clause license; Creative Commons Attribution-ShareAlike 4.0", "the cc bystander and an Apache licenses",
    "word " * 3000 + "all rights reserved " + "CC BY " * 500, "émit license mit licenseé mit license",
]


def plain(text, rules):
    words = WORD.findall((text or "").translate(LOWER))
    norm = " " + "".join(w + " " for w in words) if words else ""
    dets = []
    for i, r in enumerate(rules):
        if f" {r.keyword} " not in norm:
            continue
        for m in re.finditer(f"(?<= )(?:{r.regex})(?= )", norm):
            a = norm[:m.start()].count(" ") - 1
            dets.append((i, a, a + m[0].count(" ") + 1, r.priority))
    kept = []
    for i, a, b, p in dets:
        holds = [(j, c, d, q) for j, c, d, q in dets
                 if c <= a and b <= d and q <= p and ((c, d) != (a, b) or (q, j) < (p, i))]
        if not holds:
            kept.append((a, b, i))
    return words, dets, kept


def test_detections_and_suppression_equal_a_plain_scan(spark):
    rules = build_rules()
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, kept_elsewhere int")
    for r in scan_licenses(df, rules).collect():
        words, dets, kept = plain(r.text, rules)
        assert r.n_words == len(words) and r.kept_elsewhere == 7
        assert sorted((d.rule, d.start, d.end, d.priority) for d in r.detections) == sorted(dets)
        assert sorted((k.start, k.end, k.rule) for k in r.kept) == sorted(kept)


def test_report(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[4]), (4, TEXTS[4])]
    out = license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    for r, (doc, text) in zip(out, rows):
        words = WORD.findall((text or "").translate(LOWER))
        places = [(i, lab) for p, lab in BASE_PHRASES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        assert r.doc_id == doc and r.n_words == len(words) and r.n_base == len(places)
        assert r.first_word == (min(places)[0] if places else None) and r.last_word == (max(places)[0] if places else None)
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    got = {r.doc_id: r.labels for r in out}
    assert got[5] == "cc-by,cc-by-nc-4.0" and got[6] == "gpl,gpl-3" and got[7] == "apache,apache-2.0" and got[8] == "mpl-2.0"
    assert got[0] == got[1] == got[3] == ""


def test_there_are_hundreds_of_rules_and_an_empty_table_scans(spark):
    assert len(build_rules()) > 300
    assert license_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = license_report(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


LOST = [
    ("Under the Affero General Public License, version 3", "agpl-3"), ("Affero General Public License", "agpl"),
    ("SPDX-License-Identifier: MIT", "mit"), ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
    ("SPDX-License-Identifier: ISC", "isc"), ("SPDX-License-Identifier: Zlib */", "zlib"),
    ("SPDX-License-Identifier: BSL-1.0", "bsl-1.0"), ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2"),
    ("released under the GPL", "gpl"), ("licensed under the LGPL", "lgpl"), ("distributed under the terms of the AGPL", "agpl"),
    ("covered by the MPL", "mpl"), ("made available under the EPL.", "epl"), ("released under the GPL version 3", "gpl-3"),
    ("published by MIT, served by apache 2.0, an isc and zlib; the gpl", ""),
]


def test_spdx_identifiers_short_names_and_affero_without_gnu(spark):
    out = license_report(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LOST)], "doc_id long, text string")).collect()
    assert {LOST[r.doc_id][0]: r.labels for r in out} == dict(LOST)


def test_the_keyword_gate_loses_nothing():
    norms = [" " + "".join(w + " " for w in WORD.findall(t.translate(LOWER))) for t in [t for t in TEXTS if t] + [t for t, _ in LOST]]
    for r in build_rules():
        regex = re.compile(f"(?<= )(?:{r.regex})(?= )")
        assert all(f" {r.keyword} " in n for n in norms if regex.search(n)), r.name


def test_many_detections_take_less_than_square_time(spark):
    import time

    def seconds(n):
        df = spark.createDataFrame([(1, "mit license " * n)], "doc_id long, text string")
        began = time.time()
        r = license_report(df).first()
        assert (r.n_base, r.first_word, r.last_word, r.n_words) == (n, 0, 2 * (n - 1), 2 * n) and r.n_kept == n
        return time.time() - began

    seconds(1000)
    assert seconds(16000) < 6 * max(seconds(4000), 0.5)
