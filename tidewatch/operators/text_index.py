"""An inverted index that lives in tables: postings in blocks, one segment per batch, merged by size.

A segment has three tables.  ``postings`` has a row per term and range of documents (a block): how many documents of the range hold the term, the
largest term frequency and the smallest document length among them, and the documents with length, frequency and the term's places.  ``terms`` has
the document frequency of every term.  ``words`` of a stemmed index has the stem of every word that earlier segments had not seen.

A range holds documents of like length, about ``range_docs`` of them.  A query reads the block heads of its terms (a few numbers each), which bound
the score of every document of a range; it scores the most promising ranges, and then only those others whose bound reaches the k-th
score found.  Nothing that could win is left out, so the result is that of scoring all documents.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import stemming
from tidewatch.functions import text as X
from tidewatch.operators.search import B, K1
from tidewatch.session import cut_lineage
from tidewatch.sources.manifest import Manifest

#: Scores are rounded to six places; a bound may fall short of a rounded score by less than this.
SLACK = 2e-6
#: Words that a task of a writer deals with, about.
TASK_WORDS = 1 << 20
#: Bytes of a row group of the postings.
ROW_GROUP = 4 << 20


@dataclass
class Found:
    """Hits (id, score), best first, and how many blocks the query's terms have and how many were read."""

    rows: DataFrame
    blocks: int
    read: int


class TextIndex:
    """The index under ``root``.  With ``stemmed`` the terms are word stems, of texts and queries alike.

    Documents come in batches by ``add``; their ids must be new.  ``fanout`` segments of a tier are merged into one of the next, so a corpus of n
    batches has about fanout * log n segments, and a document is rewritten log n times.
    """

    def __init__(self, spark: SparkSession, root: str, *, stemmed: bool = False, range_docs: int = 128, fanout: int = 4):
        self.spark, self.root = spark, root.rstrip("/")
        self.stemmed, self.range_docs, self.fanout = stemmed, range_docs, fanout
        self.manifest = Manifest(spark, self.root)

    # ---- writing ----

    def add(self, docs: DataFrame, id_col: str, text_col: str, batch: str | None = None) -> None:
        """Index a batch.  A batch whose name the index already has is left out, so a writer that died may repeat it."""
        version, segments = self.manifest.read()
        if batch is not None and any(batch in s["batches"] for s in segments):
            return
        words = cut_lineage(docs.select(F.col(id_col).alias("id"), X.search_words(F.col(text_col)).alias("w")).withColumn("len", F.size("w")))
        segment = self._new_segment(0, [] if batch is None else [batch])
        lengths = words.groupBy(self._band(F.col("len")).alias("band")).agg(F.count("*").alias("n"), F.sum("len").alias("len")).collect()
        segment["bands"] = {str(r.band): r.n for r in lengths}
        segment["n"], segment["len"] = sum(r.n for r in lengths), sum(r["len"] for r in lengths)
        # The texts meet by range, their words in one string; these are taken apart there, and no posting is shuffled.
        texts = self._dealt(words.filter("len > 0").select("id", "len", F.array_join("w", " ").alias("w")), segment)
        rows = texts.select("id", "len", "range", F.posexplode(F.split("w", " ")).alias("place", "term"))
        if self.stemmed:
            rows = self._stemmed(rows, words, segment, segments)
        self._write(rows.groupBy("range", "id", "len", "term").agg(F.sort_array(F.collect_list("place")).alias("places")), segment)
        segments = self._tiered([*segments, segment])
        self.manifest.publish(version + 1, segments)

    @staticmethod
    def _new_segment(tier: int, batches: list[str]) -> dict:
        return {"name": f"segment-{uuid.uuid4().hex}", "tier": tier, "batches": batches}

    @staticmethod
    def _band(length: Column) -> Column:
        """Lengths of a band differ by less than a fifth; there are a few hundred bands at most."""
        return F.floor(4 * F.log2(length + 1)).cast("int")

    def _stemmed(self, rows: DataFrame, words: DataFrame, segment: dict, segments: list[dict]) -> DataFrame:
        """Stem each distinct word once: those of earlier segments are known."""
        new = words.select(F.explode("w").alias("word")).distinct()
        known = self._table(segments, "words")
        if known is not None:
            new = new.join(known, "word", "left_anti")
        path = f"{self.root}/{segment['name']}/words"
        stemming.with_stem(new, "word").write.parquet(path)
        every = self._table([*segments, segment], "words")
        return rows.join(every, F.col("term") == F.col("word")).select("id", "len", "range", "place", F.col("stem").alias("term"))

    def _dealt(self, rows: DataFrame, segment: dict) -> DataFrame:
        """Rows of documents (id, len, ...) with their range; those of a range are in one task, which has about TASK_WORDS words."""
        bands = {int(band): n for band, n in segment["bands"].items()}
        # a range of long documents holds fewer of them
        docs = {band: max(1, min(self.range_docs, TASK_WORDS >> band // 4)) for band in bands}
        band = self._band(F.col("len"))
        ranges = F.create_map(*[F.lit(x) for b, n in bands.items() for x in (b, -(-n // docs[b]))]) if bands else None
        place = band.cast("bigint") * (1 << 32) + F.pmod(F.xxhash64("id"), F.element_at(ranges, band)) if bands else F.lit(0).cast("bigint")
        return rows.withColumn("range", place).repartition(max(1, -(-(segment["len"] or 0) // TASK_WORDS)), "range")

    def _write(self, posts: DataFrame, segment: dict) -> None:
        """Blocks of (id, len, term, places), dealt by range; a file is sorted by term, so that a reader of few terms skips most of its row groups and pages."""
        doc = F.struct("id", "len", F.size("places").alias("tf"), "places")
        blocks = posts.groupBy("range", "term").agg(
            F.count("*").alias("n"), F.max(F.size("places")).alias("max_tf"), F.min("len").alias("min_len"), F.collect_list(doc).alias("docs"))
        where = f"{self.root}/{segment['name']}"
        blocks = blocks.select("term", "range", "n", "max_tf", "min_len", "docs", F.lit(segment["name"]).alias("segment"))
        blocks.sortWithinPartitions("term", "range").write.option("parquet.block.size", ROW_GROUP).parquet(f"{where}/postings")
        self._table([segment], "postings").groupBy("term").agg(F.sum("n").alias("df")).sort("term").write.parquet(f"{where}/terms")

    def _tiered(self, segments: list[dict]) -> list[dict]:
        for tier in range(max((s["tier"] for s in segments), default=0) + 1):
            same = [s for s in segments if s["tier"] == tier]
            if len(same) >= self.fanout:
                segments = [s for s in segments if s["tier"] != tier] + [self._merged(same, tier + 1)]
        return segments

    def _merged(self, segments: list[dict], tier: int) -> dict:
        """One segment of several: postings are dealt to new ranges, texts are not read again."""
        merged = self._new_segment(tier, [b for s in segments for b in s["batches"]])
        merged["bands"] = {b: sum(s["bands"].get(b, 0) for s in segments) for s in segments for b in s["bands"]}
        merged["n"], merged["len"] = sum(s["n"] for s in segments), sum(s["len"] for s in segments)
        posts = self._table(segments, "postings").select("term", F.explode("docs").alias("d"))
        self._write(self._dealt(posts.select("d.id", "d.len", "term", "d.places"), merged), merged)
        if self.stemmed:
            self._table(segments, "words").write.parquet(f"{self.root}/{merged['name']}/words")
        return merged

    def vacuum(self) -> None:
        """Remove segments that the newest version does not list (merged ones, and those of writers that died)."""
        listed = {s["name"] for s in self.manifest.read()[1]}
        for folder in self.manifest.folders():
            if folder not in listed:
                self.manifest.remove(folder)
        self.manifest.forget()

    # ---- reading ----

    def _table(self, segments: list[dict], name: str) -> DataFrame | None:
        paths = [f"{self.root}/{s['name']}/{name}" for s in segments]
        return self.spark.read.parquet(*paths) if paths else None

    def topk(self, query: str, k: int, *, boolean: bool = False, probe: int = 8) -> Found:
        """The best k documents for the words of a query, any of which may be missing; with ``boolean`` those that satisfy it as a web-style query
        (``X.search_clauses``).  Ties are broken by id."""
        _, segments = self.manifest.read()
        groups = X.search_clauses(query)
        if self.stemmed:
            stem = stemming.stems(self.spark, [w for g in groups for _, words in g for w in words])
            groups = [[(wanted, [stem[w] for w in words]) for wanted, words in g] for g in groups]
        terms = list(dict.fromkeys(w for g in groups for wanted, words in g if wanted for w in words))
        used = list(dict.fromkeys(w for g in groups for _, words in g for w in words)) if boolean else terms
        n, length = sum(s["n"] for s in segments), sum(s["len"] for s in segments)
        postings = self._table(segments, "postings")
        if postings is None:
            raise ValueError(f"{self.root} has no segment yet")
        if not terms:
            return Found(postings.select(F.element_at("docs.id", 1).alias("id"), F.lit(0.0).alias("score")).limit(0), 0, 0)
        df = {r.term: r.df for r in self._table(segments, "terms").filter(F.col("term").isin(terms)).groupBy("term").agg(F.sum("df").alias("df")).collect()}
        avg = length / max(n, 1) or 1.0
        idf = F.create_map(*[F.lit(x) for t in terms for x in (t, math.log(1 + (n - df.get(t, 0) + 0.5) / (df.get(t, 0) + 0.5)))])

        def weight(tf: Column, size: Column) -> Column:
            return F.coalesce(idf[F.col("term")], F.lit(0.0)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / avg))
        heads = postings.filter(F.col("term").isin(terms)).groupBy("segment", "range").agg(
            F.sum(weight(F.col("max_tf"), F.col("min_len"))).alias("bound"), F.count("*").alias("blocks"))
        heads = cut_lineage(heads)
        order = [F.desc("bound"), F.asc("segment"), F.asc("range")]
        first = [(r.segment, r.range) for r in heads.orderBy(*order).limit(probe).collect()]
        best = [F.desc("score"), F.asc("id")]
        chosen = F.lit(False)
        for segment, place in first:
            chosen = chosen | ((F.col("segment") == segment) & (F.col("range") == place))
        top = cut_lineage(self._scored(postings.filter(chosen), used, groups if boolean else None, weight).orderBy(*best).limit(k))
        state = top.agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
        bar = state.least if state.n == k else float("-inf")
        more = cut_lineage(heads.filter(~chosen & (F.col("bound") + SLACK >= bar)))
        rest = self._scored(postings.join(more.select("segment", "range"), ["segment", "range"], "left_semi"), used, groups if boolean else None, weight)
        blocks = heads.agg(F.sum("blocks").alias("all"), F.sum(F.when(chosen | (F.col("bound") + SLACK >= bar), F.col("blocks"))).alias("read")).first()
        return Found(top.unionByName(rest).orderBy(*best).limit(k), blocks["all"] or 0, blocks["read"] or 0)

    @staticmethod
    def _scored(postings: DataFrame, used: list[str], groups, weight) -> DataFrame:
        """(id, score) of the documents of some blocks that hold a wanted term (and satisfy the query)."""
        rows = postings.filter(F.col("term").isin(used)).select("term", F.explode("docs").alias("d")).select("term", "d.*")
        score = F.sum(weight(F.col("tf"), F.col("len")))
        if groups is None:
            return rows.groupBy("id").agg(F.round(score, 6).alias("score"))
        places = F.map_from_entries(F.collect_list(F.struct("term", "places")))
        hits = rows.groupBy("id").agg(F.round(score, 6).alias("score"), places.alias("found"))

        def holds(words: list[str]) -> Column:
            at = [F.coalesce(F.element_at("found", w), F.array().cast("array<int>")) for w in words]
            return F.exists(at[0], lambda p: all_of([F.array_contains(a, p + i) for i, a in enumerate(at[1:], 1)]))
        match = F.lit(False)
        for group in groups:
            match = match | all_of([holds(words) if wanted else ~holds(words) for wanted, words in group])
        wanted = [w for g in groups for yes, words in g if yes for w in words]
        scored = any_of([F.map_contains_key("found", w) for w in dict.fromkeys(wanted)])
        return hits.filter(match & scored).select("id", "score")


def all_of(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
