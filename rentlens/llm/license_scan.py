"""Licence scan: ordered signature rules over whole texts.

Each text is normalised to its words, lower-cased and joined by single
spaces. Keywords found in it switch on their rules; each rule's regex is
matched over the whole text, so a detection is a rule and an interval of
words. Detections are resolved by priority and containment: one that lies
within another of the same or a better priority is suppressed.

All of it is one projection over the documents: no shuffle, and a text meets
only the rules whose keyword it holds. Suppression is a single sweep over the
detections sorted by start: an interval is inside an earlier one of a good
enough priority when the greatest end seen so far at that priority reaches
its own end.

Defined cases: a NULL text counts as empty; a text without words has no
detections; a text is read whole, and one with very many detections takes time
in proportion to their number times its root; of equal intervals at one priority
the first rule stays; repeated rows are scanned alike. Other columns are carried through untouched unless
they share an output name, where the output wins.

Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii
from .license_rules import LicenseRule, build_rules

# Runs between words: every ASCII character but digits and lower-case letters.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PRIORITIES = 3
# Lists of up to this many items are folded whole.
WHOLE_FOLD = 256


def normalised(text) -> Column:
    """Words, each followed by one space, with one space in front; '' without words."""
    body = F.trim(F.regexp_replace(lower_ascii(text), GAPS, " "))
    return F.when(body == "", F.lit("")).otherwise(F.concat(F.lit(" "), body, F.lit(" ")))


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _matches(norm: Column, rule: Column) -> Column:
    """Word intervals ``(start, end)`` of a rule's matches; end is behind the last word."""
    regex = F.concat(F.lit("(?<= )(?:"), rule["regex"], F.lit(")(?= )"))
    found = F.regexp_extract_all(norm, regex, F.lit(0))
    # Text between matches and the matches themselves, as counts of spaces.
    steps = F.zip_with(F.split(norm, regex, -1), found, lambda gap, hit: F.struct(
        F.coalesce(_spaces(gap), F.lit(0)).alias("gap"), _spaces(hit).alias("hit")))
    at = F.struct(F.lit(-1).alias("at"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def move(state, s):
        return F.struct((state["at"] + s["gap"] + F.coalesce(s["hit"], F.lit(0))).alias("at"))

    def hit(state, s):
        a = state["at"] + s["gap"]
        one = F.array(F.struct(a.alias("start"), (a + s["hit"] + 1).alias("end")))
        return F.when(s["hit"].isNull(), none).otherwise(one)

    return _running(steps, at, move, hit, none)


def _running(items: Column, state: Column, move, emit, none: Column) -> Column:
    """What ``emit(state, item)`` gives along the items, the state going on by ``move(state, item)``.

    Appending to a fold's result copies what it holds, so a long list is folded
    in pieces of about the root of its length: first each piece's starting
    state, then the pieces, each from its own.
    """
    def fold(xs, first):
        return F.aggregate(
            xs, F.struct(first.alias("state"), none.alias("out")),
            lambda acc, x: F.struct(move(acc["state"], x).alias("state"),
                                    F.concat(acc["out"], emit(acc["state"], x)).alias("out")),
            lambda acc: acc["out"])

    def cut(xs):
        size = F.ceil(F.sqrt(F.size(xs))).cast("int")
        return F.transform(F.sequence(F.lit(0), ((F.size(xs) - 1) / size).cast("int")), lambda i: F.slice(xs, i * size + 1, size))

    def by_piece(pieces):
        starts = F.aggregate(
            pieces, F.struct(state.alias("state"), F.slice(F.array(state), 1, 0).alias("all")),
            lambda acc, xs: F.struct(F.aggregate(xs, acc["state"], move).alias("state"),
                                     F.concat(acc["all"], F.array(acc["state"])).alias("all")),
            lambda acc: acc["all"])
        return F.flatten(F.zip_with(pieces, starts, fold))

    return _bound(items, lambda xs: F.when(F.size(xs) <= WHOLE_FOLD, fold(xs, state)).otherwise(_bound(cut(xs), by_piece)))


def _bound(value: Column, use) -> Column:
    """``use(value)``, the value being computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _resolve(dets: Column) -> Column:
    """Detections that no interval of the same or a better priority holds."""
    order = F.sort_array(F.transform(dets, lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("neg_end"), d["priority"].alias("priority"),
        d["rule"].alias("rule"))))
    ends = F.struct(*[F.lit(-1).alias(f"e{p}") for p in range(PRIORITIES)])
    none = F.array().cast("array<struct<start:int,end:int,rule:int>>")

    def move(state, d):
        return F.struct(*[F.when(d["priority"] == p, F.greatest(state[f"e{p}"], -d["neg_end"])).otherwise(state[f"e{p}"])
                          .alias(f"e{p}") for p in range(PRIORITIES)])

    def keep(state, d):
        reach = F.lit(-1)
        for p in range(PRIORITIES):
            reach = F.greatest(reach, F.when(d["priority"] >= p, state[f"e{p}"]).otherwise(F.lit(-1)))
        one = F.array(F.struct(d["start"].alias("start"), (-d["neg_end"]).alias("end"), d["rule"].alias("rule")))
        return F.when(reach >= -d["neg_end"], none).otherwise(one)

    return _running(order, ends, move, keep, none)


def _rules_column(rules: list[LicenseRule]) -> Column:
    rows = ", ".join(f"struct({i} AS rule, '{r.keyword}' AS keyword, r'{r.regex}' AS regex, {r.priority} AS priority)"
                     for i, r in enumerate(rules))
    return F.expr(f"array({rows})")


def scan_licenses(docs: DataFrame, rules: list[LicenseRule] | None = None, text: str = "text") -> DataFrame:
    """Adds ``n_words``, ``detections`` and ``kept`` to every row of ``docs``.

    ``detections array<struct<rule,start,end,priority>>`` holds every match of
    every rule that is switched on, ``kept array<struct<start,end,rule>>`` what
    suppression leaves; ``rule`` is the place in the list of rules.
    """
    rules = build_rules() if rules is None else rules
    keywords = sorted({r.keyword for r in rules})
    kw = F.array(*[F.lit(k) for k in keywords])
    out = docs.withColumn("_norm", normalised(text))
    out = out.withColumn("n_words", F.greatest(_spaces(F.col("_norm")) - 1, F.lit(0)).cast("long"))
    out = out.withColumn("_kw", F.filter(kw, lambda k: F.contains(F.col("_norm"), F.concat(F.lit(" "), k, F.lit(" ")))))
    live = F.filter(_rules_column(rules), lambda r: F.array_contains(F.col("_kw"), r["keyword"]))
    dets = F.flatten(F.transform(live, lambda r: F.transform(
        _matches(F.col("_norm"), r), lambda m: F.struct(
            r["rule"].alias("rule"), m["start"].alias("start"), m["end"].alias("end"),
            r["priority"].alias("priority")))))
    none = F.array().cast("array<struct<rule:int,start:int,end:int,priority:int>>")
    out = out.withColumn("detections", F.when(F.size("_kw") > 0, dets).otherwise(none))
    none = F.array().cast("array<struct<start:int,end:int,rule:int>>")
    out = out.withColumn("kept", F.when(F.size("detections") > 0, _resolve(F.col("detections"))).otherwise(none))
    return out.drop("_norm", "_kw")


def license_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """The scan as one row per document: base phrase places, labels, confidence."""
    rules = build_rules()
    n_base = sum(r.base for r in rules)
    scanned = scan_licenses(docs.select("doc_id", text), rules, text)
    labels = F.array(*[F.lit(r.label) for r in rules])
    weights = F.array(*[F.lit(r.weight) for r in rules])
    base = F.filter("detections", lambda d: d["rule"] < n_base)
    base_labels = F.array_distinct(F.transform(base, lambda d: F.get(labels, d["rule"])))
    kept_labels = F.transform("kept", lambda d: F.get(labels, d["rule"]))
    starts = F.transform(base, lambda d: d["start"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, kept_labels))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda d: F.get(weights, d["rule"]))), F.lit(0.0)).alias("score"),
        F.size("kept").cast("long").alias("n_kept"))
