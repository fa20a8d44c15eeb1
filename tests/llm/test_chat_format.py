"""Chat formatting: folding, escaping, and the round trip of the rendered form."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rentlens.llm import queries as Q
from rentlens.llm.chat_format import CONTROL, END, SEP, START, events_of_turns, fold_events, format_chats, read_back
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

EVENT = "conv_id long, message_id long, seq long, step int, kind string, role string, text string"
TURN = "conv_id long, turn long, role string, text string, seq string"


def test_query_matches_its_sql(spark):
    r = compare(spark, "op3", Q.QUERIES["op3_chat_format"], Q.ORACLE["op3_chat_format"], SF_SMALL, duck(SF_SMALL))
    assert r["status"] == "match", r


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [(1, 1, 0, 0, "open", "user", "Hel"), (1, 1, 1, 0, "delta", None, "lo"), (1, 2, 2, 0, "open", "assistant", None),
           (1, 2, 3, 0, "delta", None, "bad"), (1, 2, 4, 0, "regenerate", None, "x"), (1, 2, 5, 0, "delta", None, "good"),
           (1, 1, 6, 0, "edit", None, "Bye"), (1, 1, 7, 0, "delta", None, "!"), (1, 1, 7, 1, "delta", None, "?"),
           (1, 3, 8, 0, "noise", "user", "dropped"), (None, 9, None, None, "open", None, None)]
    df = spark.createDataFrame(log, EVENT)
    for order in (df, df.orderBy("text")):
        got = {(r.conv_id, r.message_id): (r.role, r.text) for r in fold_events(order.repartition(3)).collect()}
        assert got == {(1, 1): ("user", "Bye!?"), (1, 2): ("assistant", "good"), (None, 9): ("", "")}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(
    st.sampled_from(["user", "assistant", "system", "a<b\\", ""]),
    st.lists(st.sampled_from([*CONTROL, "\\", "<", "[", "ok", "\n", "é", "😀", "/", "|", "INST]", "s>"]), max_size=8).map("".join)),
    min_size=1, max_size=4), min_size=1, max_size=6))
def test_round_trip(spark, convs):
    rows = [(c, t, role, text, "x") for c, turns in enumerate(convs) for t, (role, text) in enumerate(turns)]
    out = read_back(format_chats(events_of_turns(spark.createDataFrame(rows, TURN), chunk=3))).collect()
    for r in out:
        assert [(t.role, t.text) for t in r.turns] == convs[r.conv_id]
        assert r.loss_texts == [t for role, t in convs[r.conv_id] if role == "assistant"]
        assert r.n_turns == len(convs[r.conv_id])
        bare = r.formatted.replace(START, "").replace(SEP, "").replace(END, "")
        assert not any(c in bare for c in CONTROL) or r.formatted.count(START) == r.n_turns


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, 0, "user", None, "x"), (1, 0, "user", None, "x"), (1, None, None, "first", "x"), (None, 1, "assistant", "a", "x")]
    got = {r.conv_id: r for r in read_back(format_chats(events_of_turns(spark.createDataFrame(rows, TURN)))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("", "first"), ("user", ""), ("user", "")]
    assert got[None].loss_texts == ["a"]
    assert format_chats(events_of_turns(spark.createDataFrame([], TURN))).count() == 0
