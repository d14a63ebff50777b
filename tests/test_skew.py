"""A key holding a third of all events: results stay exact (partial top-1 handles the hot key)."""

from pyspark.sql import functions as F

from helpers import SF001

from tidemark.operators.refine import clean, current_rows, latest_per_key, merge_changes
from tidemark.sources import feeds
from tidemark.spec import SALES_SEQ as S


def hot_feed(spark):
    feed = feeds.change_feed_a(spark, SF001)
    # skew fixture: every third event is re-keyed onto one hot key
    return feed.withColumn("tx_id", F.when(F.col("seq") % 3 == 0, F.lit("HOT")).otherwise(F.col("tx_id")))


def test_hot_key_latest_event_is_exact(spark):
    feed = hot_feed(spark)
    total = feed.count()
    hot = feed.filter(F.col("tx_id") == "HOT")
    assert hot.count() * 4 > total                              # about a third of all events
    latest = latest_per_key(clean(feed, S), S)
    got = latest.filter(F.col("tx_id") == "HOT").collect()
    want = clean(hot, S).orderBy(F.col("timestamp").desc(), F.col("seq").desc()).first()
    assert len(got) == 1 and tuple(got[0]) == tuple(want)
    assert latest.count() == latest.select("tx_id").distinct().count()


def test_hot_key_merge_matches_one_shot(spark):
    feed = hot_feed(spark)
    early = F.col("timestamp") < F.lit("1998-06-01")
    silver = current_rows(latest_per_key(clean(feed.filter(early), S), S), S)
    merged = merge_changes(silver, feed.filter(~early), S)
    one_shot = current_rows(latest_per_key(clean(feed, S), S), S)
    assert merged.exceptAll(one_shot).count() == 0 and one_shot.exceptAll(merged).count() == 0
