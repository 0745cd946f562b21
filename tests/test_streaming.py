"""The batch scoring path runs unchanged on a streaming source and gives the batch scores."""

import tempfile


from riskframe.operators import models as ML
from riskframe.operators.roles import resolve_event_time
from riskframe.plans.preprocess import run_preprocess
from riskframe.sources.fixtures import txn_raw
from riskframe.streaming import score_transactions

SF = "/root/testdata/sf0.001"


def test_stream_scores_equal_batch(spark):
    raw = txn_raw(spark, SF)
    prep = run_preprocess(raw, None, row_key="Transaction_ID")
    model = ML.fit_logistic(prep.vectors.where("split = 'train'"))
    ts, _ = resolve_event_time(raw)
    feed = tempfile.mkdtemp(prefix="riskframe-stream-")
    raw.drop("Is_Fraud").write.mode("overwrite").parquet(feed + "/in")
    stream = spark.readStream.schema(raw.drop("Is_Fraud").schema).parquet(feed + "/in")
    scored = score_transactions(stream, prep.model.roles, ts, prep.prep, model, "lr", row_key="Transaction_ID")
    q = scored.writeStream.format("memory").queryName("scored_stream").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r["row_id"]: r["score"] for r in spark.sql("SELECT * FROM scored_stream").collect()}
    batch = score_transactions(raw.drop("Is_Fraud"), prep.model.roles, ts, prep.prep, model, "lr",
                               row_key="Transaction_ID")
    want = {r["row_id"]: r["score"] for r in batch.collect()}
    assert len(got) == 1000 and got == want
