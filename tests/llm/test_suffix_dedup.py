"""Suffix-array dedup against brute force over all windows."""

from collections import defaultdict

import pytest

from rentlens.llm import suffix_dedup as S

COLS = "doc_id long, text string, lang string, n_chars long"


def brute(rows):
    """Spans (doc, text, start, end, owner, duplicate) from every window of every text."""
    where = defaultdict(set)
    docs = {(d is None, d or 0, t or "") for d, t in rows}
    for doc in docs:
        w = doc[2].encode().split()
        for i in range(len(w) - S.MIN_WORDS + 1):
            where[tuple(w[i:i + S.MIN_WORDS])].add((doc, i))
    starts = defaultdict(list)
    for occ in where.values():
        ids = {(d[0], d[1]) for d, _ in occ}
        if len({d for d, _ in occ}) > 1:
            low = min(ids)
            for d, i in occ:
                starts[(d, low, (d[0], d[1]) != low)].append(i)
    out = set()
    for (d, low, dup), at in starts.items():
        at.sort()
        s, e = at[0], at[0] + S.MIN_WORDS
        for i in at[1:]:
            if i > e:
                out.add((None if d[0] else d[1], s, e, None if low[0] else low[1], dup))
                s = i
            e = i + S.MIN_WORDS
        out.add((None if d[0] else d[1], s, e, None if low[0] else low[1], dup))
    return out


def corpus(prose):
    shared, line, half = prose(80), prose(30), prose(49)
    rows = [(1, prose(120)), (2, prose(30) + " " + shared + " " + prose(20)), (3, shared), (4, prose(60) + "\n" + shared),
            (5, half + " x " + prose(10)), (6, half + " y " + prose(10)), (7, None), (8, ""), (9, "be " * 200), (10, "be " * 130),
            (11, prose(12) + " " + line + " " + prose(40)), (12, prose(60))]
    left, right = prose(12), prose(12)
    # Only together are these 54 words shared; the middle line is common.
    rows += [(13, prose(40) + " " + left + " " + line + " " + right + " " + prose(40)), (14, left + " " + line + " " + right)]
    rows += [(100 + i, prose(15) + " " + line + " " + prose(15)) for i in range(30)]
    rows += [(200 + i, rows[0][1]) for i in range(5)] + [(None, shared + " " + prose(55))]
    near = prose(300).split()
    for i in range(6):
        w = list(near)
        w[50 * i + 7] = f"changed{i}"
        rows.append((300 + i, " ".join(w)))
    rows.append(rows[2])  # a repeated row
    return rows


def spans(df):
    got = [(r.doc_id, r.start, r.end, r.owner_id, r.duplicate) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("crowd", [1e9, 0.25, 0.0])
def test_spans_equal_brute_force_by_either_road(spark, prose, crowd):
    rows = corpus(prose)
    df = spark.createDataFrame([(d, t, "en", 0) for d, t in rows], COLS).repartition(5)
    assert spans(S.shared_spans(df, crowd=crowd)) == brute(rows)


def test_crowded_seeds_are_counted_over_all_documents(spark, prose):
    rare = prose(60)  # in 7 of 700 documents
    rows = [(i, (rare + " " if i % 100 == 3 else "") + prose(70)) for i in range(700)] + [(None, None), (701, "")]
    count = defaultdict(int)
    for _, t in rows:
        for s in S.minimisers(S.word_hashes(t))[0].tolist():
            count[s] += 1
    total = sum(count.values())
    keyed = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for crowd in (0.0, 5 * 8 / total, 7.5 * 8 / total):
        want = sorted(s for s, n in count.items() if n > 3 and n > crowd * total / 8)
        assert sorted(S._hot_seeds(keyed, crowd, 8).tolist()) == want
    assert len(S._hot_seeds(keyed, 5 * 8 / total, 8)) > 0 == len(S._hot_seeds(keyed, 7.5 * 8 / total, 8))
    assert len(S._hot_seeds(keyed.limit(0), 0.0, 8)) == 0


@pytest.mark.parametrize("crowd", [1e9, 0.0])
def test_a_row_repeated_many_times_gives_its_spans_once(spark, prose, crowd):
    text = prose(90)
    rows = [(5, text)] * 300 + [(6, prose(20) + " " + text)] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert spans(S.shared_spans(df, crowd=crowd)) == brute(rows)


def test_removal_keeps_first_copies_and_clean_texts(spark, prose):
    rows = corpus(prose)
    df = spark.createDataFrame([(d, t, "en", 0) for d, t in rows], COLS)
    out = {r.doc_id: r for r in S.remove_duplicates(df).collect()}
    assert out[1].text == rows[0][1] and out[12].text == rows[11][1] and out[2].text == rows[1][1]
    assert out[5].text == rows[4][1] and out[7].text is None and out[8].text == ""
    assert 3 not in out and 200 not in out
    assert out[4].text == rows[3][1].split("\n")[0] + "\n" and out[4].n_chars == len(out[4].text)


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, key long, start int, seed string")
    assert S.shared_spans(empty).count() == 0
    assert S.remove_duplicates(empty).columns == empty.columns


def test_minimisers_cover_every_window(prose):
    h = S.word_hashes(prose(500) + " be" * 300)
    _, pos, first, last = S.minimisers(h)
    starts = [s for a, b in zip(first, last) for s in range(a, b + 1)]
    assert starts == list(range(len(h) - S.MIN_WORDS + 1))
    assert all(a <= p <= b + S.REACH for p, a, b in zip(pos, last, first))


def test_cutting_words():
    assert S.without_words("a b  c d", [(1, 2)]) == "a c d"
    assert S.without_words("a b", [(0, 2)]) == ""
    assert S.without_words(" a b c", [(0, 1), (2, 3)]) == " b "
