"""New records against a fixed world of S1 records: each micro-batch is normalised, blocked, ranked and written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from recordloom.operators import blocking, normalize
from recordloom.sources.artifacts import saved


class World:
    """What batches are held against: records, and all statistics that decide a score, taken from the records once.

    records: built records of source 1, and those of the other sources that the statistics should count. Area tokens come from
    all of them, a pass's greatest score from the hits of the other sources' records; a pass or country without any has none,
    and a hit there, or one beyond the greatest, counts 1.
    """

    def __init__(self, records: DataFrame, limits: blocking.Limits = blocking.Limits()):
        self.records = saved(records, "world")
        self.index = blocking.Index(self.records, limits)
        self.areas = saved(normalize.area_tokens(self.records), "world-areas")
        self.most = saved(blocking.greatest_scores(self.index.passes()), "world-scores")

    def candidates(self, batch: DataFrame) -> DataFrame:
        """The ranked candidates of a batch of raw records. A record's candidates don't depend on the batch that it came in."""
        limits = self.index.limits
        new = saved(normalize.build_records(batch, areas=self.areas), "batch")
        merged = blocking.merge_passes(self.index.passes(new), most=self.most)
        both = self.records.filter("source = 1").unionByName(new.select(*self.records.columns))
        return blocking.rank_per_cand(blocking.rank_scores(merged, both), limits.k_per_query, limits.min_score)


def start(stream: DataFrame, world: World, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Writes every batch's candidates under path/batch=N; a batch that is run again replaces what it wrote."""

    def write(batch: DataFrame, number: int) -> None:
        world.candidates(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (query.trigger(**trigger) if trigger else query).start()
