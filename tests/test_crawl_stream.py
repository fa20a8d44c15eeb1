"""The crawl cutoff as a stream against the batch rule."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentlens.sources import html_pages as H
from rentlens.streaming import crawl_stream as C
from rentlens.streaming import listings_stream as S

FACTS = T.StructType([T.StructField("source_id", T.StringType()), T.StructField("page_num", T.IntegerType()),
                      T.StructField("n_cards", T.IntegerType()), T.StructField("counter", T.IntegerType())])


def sources(rng):
    for s in range(12):
        for p in range(1, rng.randint(2, 12)):
            yield f"s{s}", p, rng.choice((0, 5, 5, 5, 5, 5)), rng.choice((None, 1, 2, 3, 4))


def test_state_survives_batches_in_any_order():
    rng = random.Random(6)
    for _ in range(200):
        pages = [p[1:] for p in sources(rng) if p[0] == "s0"]
        whole = C.Crawl(None)
        whole.come(iter(pages))
        state, last = None, 0
        rng.shuffle(pages)
        for i in range(0, len(pages), 2):
            crawl = C.Crawl(state)
            if not crawl.stopped:
                crawl.come(iter(pages[i:i + 2] + pages[:1]))  # one page comes again
                last = crawl.last
            state = crawl.state()
        assert (last, state[2]) == (whole.last, whole.stopped)


def test_stream_equals_the_batch_rule(spark, tmp_path):
    rows = list(sources(random.Random(7)))
    df = spark.createDataFrame(rows, FACTS)
    want = {r.source_id: r.last_page for r in H.page_cutoff(df).collect()}
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for lot in range(3):  # the stream is started anew for each lot
        df.filter(F.col("page_num") * 2 % 3 == lot).coalesce(1).write.mode("append").parquet(src)
        facts = S.read_stream_files(spark, src, FACTS, max_files_per_trigger=1)
        q = (C.crawl_stand(facts).writeStream.outputMode("update").option("checkpointLocation", ckpt)
             .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(S.delta_path(out, i)))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    assert {r.source_id: r.last_page for r in C.read_page_cutoff(spark, out).collect()} == want
