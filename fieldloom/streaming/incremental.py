"""Document sink with the state that the batch plan has for free.

Whether a block of a page is boilerplate depends on how many pages of its site
hold it, in earlier and later micro-batches alike.  The sink keeps, as Parquet
tables in a shared folder, what the pages seen so far say about that:

* ``pages/epoch=e``   the parsed pages that came in epoch ``e`` (no HTML)
* ``blocks/epoch=e``  ``(id, site, block key)`` of their long, link-poor blocks
* ``counts/epoch=e``  ``(site, block key, pages)``: what epoch ``e`` adds to the counts
* ``totals/upto=e``   the counts summed up to ``e``, written every ``compact_every`` epochs

An epoch writes documents for its new pages, and again for every earlier page one of
whose blocks becomes boilerplate by this epoch.  A block that turns had at most
``max_site_repeats`` pages before, so this set is small: at most that many
earlier pages for each block that turns.  ``latest_documents`` keeps the last version of a
page; after any number of epochs it equals the batch result over all pages.

Replays: an epoch reads only state of earlier epochs and overwrites its own folders,
so a micro-batch that runs again (after a lost driver, say) leaves the same rows.
``out_path`` remembers the state that writes to it; a second stream with state of its own is refused
instead of overwriting the first one's epochs.

Pages that were stored in an earlier epoch are dropped by an anti join on the id alone, so the
first crawl of a page counts however late the next one comes; within an epoch one row of an id is
kept.  ``unique=True`` leaves that join out for sources without repeated ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom import config
from fieldloom.operators import content
from fieldloom.session import cut_lineage

SITE = "__site"


class DocumentSink:
    def __init__(self, spark: SparkSession, vocab: DataFrame, out_path: str, state_path: str, *, id_col: str = "page_id",
                 html_col: str = "html", url_col: str = "url", max_site_repeats: int = config.STRICT_MAX_SITE_REPEATS,
                 compact_every: int = 20, unique: bool = False, **pipeline_args):
        self.vocab, self.out, self.state = vocab, out_path.rstrip("/"), state_path.rstrip("/")
        self.id_col, self.html_col, self.url_col = id_col, html_col, url_col
        self.max_site_repeats, self.compact_every, self.unique, self.args = max_site_repeats, compact_every, unique, pipeline_args
        owner = spark.createDataFrame([(self.state,)], "state string").coalesce(1)
        owner.write.mode("ignore").parquet(f"{self.out}/owner")
        found = {r.state for r in spark.read.parquet(f"{self.out}/owner").collect()}
        if found != {self.state}:
            raise ValueError(f"{self.out} holds the documents of another stream: {sorted(found)}")

    # --- tables of the state ---------------------------------------------------------

    def _put(self, df: DataFrame, table: str, epoch: int, key: str = "epoch") -> None:
        df.write.mode("overwrite").parquet(f"{self.state}/{table}/{key}={epoch}")

    def _before(self, spark: SparkSession, table: str, epoch: int, since: int = 0) -> DataFrame | None:
        """Rows of ``table`` that epochs ``since`` to ``epoch - 1`` wrote, each folder named:
        what a failed later run left is not read."""
        paths = [f"{self.state}/{table}/epoch={e}" for e in range(since, epoch)]
        return spark.read.parquet(*paths) if paths else None

    def _total_upto(self, epoch: int) -> int:
        """The last epoch before ``epoch`` after which the totals were written, or -1."""
        return epoch // self.compact_every * self.compact_every - 1

    def counts_before(self, spark: SparkSession, epoch: int, keys: DataFrame | None = None) -> DataFrame | None:
        """Page counts of all earlier epochs, of the sites and blocks in ``keys`` or of all."""
        upto = self._total_upto(epoch)
        parts = [spark.read.parquet(f"{self.state}/totals/upto={upto}")] if upto >= 0 else []
        later = self._before(spark, "counts", epoch, upto + 1)
        parts += [later] if later is not None else []
        if not parts:
            return None
        log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if keys is not None:
            log = log.join(keys, content.same_block(log, keys, SITE), "left_semi")
        return log.groupBy(SITE, *content.BLOCK_KEY).agg(F.sum("pages").alias("pages"))

    # --- one micro-batch -------------------------------------------------------------

    def write(self, batch: DataFrame, epoch: int) -> None:
        """``foreachBatch`` function."""
        from fieldloom.plans import pipeline

        spark, id_col = batch.sparkSession, self.id_col
        new = batch.dropDuplicates([id_col])
        earlier = self._before(spark, "pages", epoch)
        if earlier is not None and not self.unique:
            seen = earlier.select(F.col(id_col).alias("__seen"))
            new = new.join(seen, F.col(id_col).eqNullSafe(F.col("__seen")), "left_anti")
        # the parsed row stays beside the page's other columns: no join, and no HTML in the state
        kept = [c for c in new.columns if c != self.html_col]
        rows = new.select(*(F.col(f"`{c}`") for c in kept), *(e.alias(n) for e, n in self._parsed_columns()))
        self._put(rows, "pages", epoch)
        rows = spark.read.schema(rows.schema).parquet(f"{self.state}/pages/epoch={epoch}")

        exploded = content.explode_blocks(rows.withColumnRenamed("__blocks", "blocks"), id_col, keep=(SITE,))
        blocks = content.keyed_blocks(exploded).select(id_col, SITE, *content.BLOCK_KEY).distinct()
        self._put(blocks, "blocks", epoch)
        blocks = spark.read.schema(blocks.schema).parquet(f"{self.state}/blocks/epoch={epoch}")
        added = blocks.groupBy(SITE, *content.BLOCK_KEY).agg(F.count(F.lit(1)).alias("pages"))
        self._put(added, "counts", epoch)
        added = spark.read.schema(added.schema).parquet(f"{self.state}/counts/epoch={epoch}")

        work = rows
        before = self.counts_before(spark, epoch, added)
        if before is not None:
            both = before.withColumn("before", F.col("pages")).unionByName(added.withColumn("before", F.lit(0).cast("long")))
            turned = (both.groupBy(SITE, *content.BLOCK_KEY).agg(F.sum("pages").alias("now"), F.sum("before").alias("before"))
                      .where((F.col("now") > self.max_site_repeats) & (F.col("before") <= self.max_site_repeats))
                      .select(SITE, *content.BLOCK_KEY))
            turned = cut_lineage(turned)
            earlier_blocks = self._before(spark, "blocks", epoch)
            again = (earlier_blocks.join(turned, content.same_block(earlier_blocks, turned, SITE), "left_semi")
                     .select(F.col(id_col).alias("__again")).distinct())
            work = rows.unionByName(earlier.join(again, F.col(id_col).eqNullSafe(F.col("__again")), "left_semi"), allowMissingColumns=True)
        work = cut_lineage(work)

        totals = self._counts_for(spark, epoch, added, work)
        parsed = work.select(id_col, F.col(SITE).alias("host"), F.col("__title").alias("title"), F.col("__blocks").alias("blocks"))
        segs = content.segments_of_rows(parsed, id_col, self.html_col, counts=totals.withColumnRenamed(SITE, "host"))
        pages = work.drop(SITE, "__title", "__blocks")
        docs = pipeline.consolidate_documents(pages, self.vocab, id_col=id_col, url_col=self.url_col, segments=segs, **self.args)
        docs.write.mode("overwrite").parquet(f"{self.out}/documents/epoch={epoch}")
        if (epoch + 1) % self.compact_every == 0:
            every = self.counts_before(spark, epoch, None)
            every = added if every is None else every.unionByName(added).groupBy(SITE, *content.BLOCK_KEY).agg(F.sum("pages").alias("pages"))
            self._put(every, "totals", epoch, "upto")

    def _parsed_columns(self):
        from fieldloom.operators.plumbing import host_of
        return [(host_of(F.col(self.url_col)), SITE), (content.extract_title(F.col(self.html_col)), "__title"),
                (content.html_blocks(self.html_col), "__blocks")]

    def _counts_for(self, spark: SparkSession, epoch: int, added: DataFrame, work: DataFrame) -> DataFrame:
        """Counts up to this epoch of every block of the pages in ``work``."""
        exploded = content.explode_blocks(work.withColumnRenamed("__blocks", "blocks"), self.id_col, keep=(SITE,))
        keys = content.keyed_blocks(exploded).select(SITE, *content.BLOCK_KEY).distinct()
        before = self.counts_before(spark, epoch, keys)
        if before is None:
            return added
        return before.unionByName(added).groupBy(SITE, *content.BLOCK_KEY).agg(F.sum("pages").alias("pages"))


def latest_documents(spark: SparkSession, out_path: str, id_col: str = "page_id") -> DataFrame:
    """The last version of each document that a ``DocumentSink`` wrote."""
    docs = spark.read.parquet(f"{out_path.rstrip('/')}/documents")
    last = docs.groupBy(F.col(id_col).alias("__id")).agg(F.max("epoch").alias("__epoch"))
    return (docs.join(last, docs[id_col].eqNullSafe(last["__id"]) & (docs["epoch"] == last["__epoch"]), "left_semi").drop("epoch"))
