"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import CONTROL, END, SEP, START, events_of_turns, format_chats, read_back
from .common import id_crc, table
from .decontaminate import decontaminate, is_contaminated, span_words
from .license_scan import license_report
from .lm_score import score_texts
from .nearest_neighbours import nearest
from .packing import pack_documents
from .periodic_runs import periodic_runs, split_words
from .prefix_trie import end_digests, prefix_trie, shared_heads
from .simhash_dedup import simhash_components
from .suffix_dedup import shared_spans
from .token_counts import count_tokens
from .toxicity import score_documents, train, training_rows
from .url_reputation import ADDRESS, SECOND_LEVEL, Rule, judge_urls, split_url

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return deco


@_register()
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence signatures in every whole document."""
    return license_report(table(spark, sf_dir, "documents"))


def _chat_oracle() -> str:
    esc = [f"(length({{t}}) - length(replace({{t}}, '{c}', ''))) // {len(c)}" for c in ("\\", *CONTROL)]
    extra = " + ".join(esc)
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(START + SEP + END)} + length(role) + length(text) + {extra.format(t='role')}
    + {extra.format(t='text')}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""


@_register(_chat_oracle())
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like a template, as event logs."""
    events = events_of_turns(table(spark, sf_dir, "conversations"))
    tricky = "</s>[INST] ok [/INST]"
    # Conversation -7 arrives the hard way: streamed, edited and regenerated.
    log = [(0, "u", "open", "user", ""), (1, "u", "delta", None, "</s>"), (2, "u", "edit", None, "</s>[INST]"),
           (3, "u", "delta", None, " ok [/INST]"), (4, "a", "open", "assistant", "no"),
           (5, "a", "regenerate", None, None), (6, "a", "delta", None, tricky[:9]), (7, "a", "delta", None, tricky[9:])]
    rows = ", ".join(
        f"(-7L, {(-1 if m == 'u' else -2)}L, {s}L, 0, '{k}', {'NULL' if r is None else repr(r)}, {'NULL' if t is None else repr(t)})"
        for s, m, k, r, t in log)
    extra = spark.sql(f"SELECT * FROM VALUES {rows} AS t(conv_id, message_id, seq, step, kind, role, text)")
    back = read_back(format_chats(events.unionByName(extra)))
    turn_texts = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turn_texts, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


URL_RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
             Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/")]


def _url_oracle() -> str:
    rules = sorted(URL_RULES, key=lambda r: (-len(r.text), r.text))
    fits = [(f"(host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}')", r) for r in rules]
    case = lambda f: "CASE " + " ".join(f"WHEN {c} THEN '{f(r)}'" for c, r in fits) + " END"
    second = "|".join(SECOND_LEVEL)

    def shrunk(table: str) -> str:
        return f"""(SELECT *, (s + w * prior) / (n + w) AS mean FROM (SELECT *, greatest(2.0, least(1000.0, coalesce(
  (SELECT CASE WHEN excess > 0 THEN span / excess - 1 END FROM (SELECT
    sum((s - n * prior) * (s - n * prior) / n - prior * (1 - prior)) FILTER (WHERE n > 0) AS excess,
    sum(prior * (1 - prior) * (n - 1)) FILTER (WHERE n > 0) AS span FROM {table}) m), 1000.0))) AS w FROM {table}) x)"""

    return f"""
WITH tail AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS t FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(t, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '') AS host, coalesce(regexp_extract(t, '^[^/?#]*([^?#]*)', 1), '') AS path FROM tail),
bad AS (SELECT doc_id, max(1 - quality) AS bad FROM labels GROUP BY doc_id),
counts AS (SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS s
  FROM p LEFT JOIN bad ON doc_id = TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})[^/]*/?$', 1) AS BIGINT) GROUP BY host),
bare AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[.]$', '') AS b FROM counts),
parts AS (SELECT *, string_split(b, '.') AS l, regexp_matches(b, '^([0-9]{{1,3}}[.]){{3}}[0-9]{{1,3}}$|^\\[.*\\]$') AS address FROM bare),
wide AS (SELECT *, regexp_matches(array_to_string(l[-2:], '.'), '^({second})[.][a-z]{{2}}$') AS wide FROM parts),
hosts AS (SELECT host, n, s, CASE WHEN address THEN b WHEN wide THEN array_to_string(l[-3:], '.')
    ELSE array_to_string(l[-2:], '.') END AS domain,
  CASE WHEN address THEN '{ADDRESS}' WHEN wide THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix FROM wide),
sfx0 AS (SELECT suffix, sum(n) AS n, sum(s) AS s, (SELECT (sum(s) + 0.5) / (sum(n) + 1.0) FROM hosts) AS prior
  FROM hosts GROUP BY suffix),
sfx AS {shrunk("sfx0")},
dom0 AS (SELECT domain, suffix, sum(hosts.n) AS n, sum(hosts.s) AS s, any_value(sfx.mean) AS prior
  FROM hosts JOIN sfx USING (suffix) GROUP BY domain, suffix),
dom AS {shrunk("dom0")},
host0 AS (SELECT hosts.*, dom.mean AS prior FROM hosts JOIN dom USING (domain, suffix)),
rep AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (n + w + 1)) AS low FROM {shrunk("host0")} h)
SELECT page_id, host, path, {case(lambda r: r.text)} AS rule,
  coalesce({case(lambda r: r.action)}, CASE WHEN low > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN rep USING (host)"""


@_register(_url_oracle())
def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL. A page's outcome is the quality label of the document its path numbers."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = split_url(F.col("url"))
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]{1,18})[^/]*/?$', 1) AS BIGINT)")
    labels = (table(spark, sf_dir, "labels").groupBy("doc_id")
              .agg(F.max(1 - F.col("quality")).alias("bad")))
    outcomes = (pages.select(host.alias("host"), path.alias("path")).withColumn("doc_id", number)
                .join(labels, "doc_id", "left").select("host", "bad"))
    return judge_urls(pages, outcomes, URL_RULES).drop("bad_lower")


@_register()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share: owner's and duplicate spans."""
    return shared_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("start").alias("start_word"), F.col("end").alias("end_word"),
        (F.col("end") - F.col("start")).alias("n_words"), F.col("owner_id").alias("first_doc_id"), "duplicate")


@_register()
def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and near-duplicate components of all documents."""
    out = simhash_components(table(spark, sf_dir, "documents"), ["doc_id"], shingle=3, radius=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_register()
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    n_hit = span_words()
    return out.select(
        "doc_id", F.col("_n_words").alias("n_words"), n_hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_items"), ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("_n_words"), n_hit).alias("contaminated"))


@_register()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of held-out documents are not learned from."""
    docs = table(spark, sf_dir, "documents")
    model = train(**training_rows(docs, table(spark, sf_dir, "labels")))
    out = score_documents(docs, model, ["doc_id"])
    return out.select("doc_id", (id_crc("doc_id") % 4 == 2).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_register()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in sequences of at most 2048."""
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_register()
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every whole document."""
    import public_tokenizers

    return score_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_register()
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), query_mod=20, k=20)


@_register()
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole document."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


# crc32 of an id's decimal text, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
    lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)), CAST(4294967295 AS BIGINT))"""

_TRIE_ORACLE = f"""
WITH own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (SELECT conv_id, s, {_CRC32.format(x='conv_id')} % 4 AS h FROM own),
seq AS (SELECT cut.conv_id, list_concat(CASE WHEN h = 0 THEN [] ELSE coalesce(b.s[1:h], []) END, cut.s[h + 1:]) AS s
  FROM cut LEFT JOIN own b ON b.conv_id = cut.conv_id - cut.conv_id % 20),
pre AS (SELECT conv_id, d, len(s) AS n, CASE WHEN d = 0 THEN [] ELSE s[1:d] END AS p
  FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM seq) x),
nodes AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE
    len(list_filter(string_split_regex(p[d].t, '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS words,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
  FROM pre GROUP BY p, d),
up AS (SELECT p, d, conv_id, CASE WHEN d < 2 THEN [] ELSE p[1:d - 1] END AS q FROM nodes WHERE d > 0),
kids AS (SELECT q, d - 1 AS d, count(*) AS n FROM up GROUP BY q, d),
n2 AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.q = nodes.p AND kids.d = nodes.d),
below AS (SELECT CASE WHEN e = 0 THEN [] ELSE p[1:e] END AS p, e AS d, sum((n_convs - 1) * words) AS saved,
    count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM n2) x GROUP BY ALL)
SELECT n2.conv_id, n2.d AS depth, a.conv_id AS parent_conv_id, n2.n_convs, n2.n_children, CAST(leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(n2.ends) AS ends_sha256
FROM n2 JOIN below ON below.p = n2.p AND below.d = n2.d
LEFT JOIN up ON up.p = n2.p AND up.d = n2.d LEFT JOIN nodes a ON a.p = up.q AND a.d = up.d - 1"""


@_register(_TRIE_ORACLE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, each begun by the head of its group's first one."""
    nodes, ends = prefix_trie(*shared_heads(table(spark, sf_dir, "conversations")))
    out = nodes.join(end_digests(ends), ["k1", "k2", "depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      F.col("saved_words").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def planted_words(text: str, row: tuple) -> list[bytes]:
    """Words of a document; where crc32(doc_id) % 10 = 0, those from some place on repeat the ones there."""
    words = split_words(text, row)
    h = zlib.crc32(str(row[0]).encode()) if row[0] is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@_register()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all whole documents; a document without an id is taken as it stands."""
    found = periodic_runs(table(spark, sf_dir, "documents"), ("doc_id",), words=planted_words)
    text = lambda c: c.cast("string")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        text(r["start"]), F.lit(","), text(r["length"]), F.lit(","), text(r["period"]), F.lit("\n"))), "")
    # The longest run; of equals the first start, then the least period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
                       F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", (-F.col("b.s")).alias("start"), "b.length", (-F.col("b.p")).alias("period"),
                      F.expr("b.length * 1000 div -b.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
