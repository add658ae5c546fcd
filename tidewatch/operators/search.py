"""Text and vector retrieval."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidewatch.functions import text as X
from tidewatch.operators.windows import top_per_key
from tidewatch.session import cut_lineage

K1, B = 1.2, 0.75


def _count(words: Column, term: str) -> Column:
    return F.size(F.filter(words, lambda w: w == term))


def bm25_scores(docs: DataFrame, text_col: str, query: str, carry: list[str], *, boolean: bool = True,
                keep: Column | None = None, times: DataFrame | None = None) -> DataFrame:
    """BM25 score of every document that holds a query word (and satisfies the query).

    Each text is tokenised once and shrinks to a few counters; the texts themselves are neither exploded nor
    shuffled.  Counts over the whole corpus are observed on the pass that writes the counters of the hits.
    ``times`` has a document's key, the first of ``carry``, and how often the corpus holds it (column ``times``);
    documents that it lacks are not part of the corpus.
    """
    terms = X.wanted_words(query)
    if not terms:  # nothing to score; an aggregate over a filter that is always false would never be observed
        return docs.select(*carry, F.lit(0.0).alias("score")).limit(0)
    wanted = F.lit(True) if keep is None else keep
    # Binding the words to a lambda variable has them computed once per document.
    facts = F.transform(F.array(X.search_words(F.col(text_col))), lambda w: F.struct(
        F.size(w).alias("len"), *[_count(w, t).alias(f"tf{i}") for i, t in enumerate(terms)],
        (X.words_match(w, query) if boolean else F.lit(True)).alias("match")))[0]
    counted = docs.select(*carry, wanted.alias("keep"), facts.alias("f")).select(*carry, "keep", "f.*")
    counted = counted.withColumn("times", F.lit(1)) if times is None else counted.join(times, carry[0])
    seen = Observation()
    counted = counted.observe(
        seen, F.sum("times").alias("n"), F.sum(F.col("times") * F.col("len")).alias("len"),
        *[F.sum(F.when(F.col(f"tf{i}") > 0, F.col("times"))).alias(f"df{i}") for i in range(len(terms))])
    hit = reduce(lambda a, b: a | b, [F.col(f"tf{i}") > 0 for i in range(len(terms))], F.lit(False))
    rows = cut_lineage(counted.filter(hit & F.col("match") & F.col("keep")))
    corpus = seen.get
    n = corpus["n"] or 0
    avg = (corpus["len"] or 0) / max(n, 1)
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, df = F.col(f"tf{i}"), corpus[f"df{i}"] or 0
        idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("len") / (avg or 1.0)))
    return rows.select(*carry, F.round(score, 6).alias("score"))


def bm25_topk(docs: DataFrame, id_col: str, text_col: str, query: str, k: int = 5) -> DataFrame:
    """Best k documents for the words of a query, any of which may be missing."""
    return (bm25_scores(docs, text_col, query, [id_col], boolean=False)
            .orderBy(F.desc("score"), id_col).limit(k))


def note_search(notes: DataFrame, id_col: str, text_col: str, query: str, carry: list[str] | None = None, k: int = 5,
                keep: Column | None = None) -> DataFrame:
    """Rows that satisfy a web-style query, best BM25 score first."""
    hits = bm25_scores(notes, text_col, query, [id_col, *(carry or [])], keep=keep)
    return hits.orderBy(F.desc("score"), id_col).limit(k)


def quoted_note_search(actions: DataFrame, notes: DataFrame, id_col: str, query: str, carry: list[str], k: int = 5,
                       keep: Column | None = None) -> DataFrame:
    """``note_search`` over actions that quote a note, (note_doc, notes), by its key ``note_doc``.

    A note is read once however many actions quote it; only its score meets the actions.
    """
    quoted = actions.groupBy("note_doc").agg(F.count(F.lit(1)).alias("times"))
    scores = bm25_scores(notes, "notes", query, ["note_doc"], times=quoted)
    found = actions if keep is None else actions.filter(keep)
    return found.join(scores, "note_doc").select(id_col, *carry, "score").orderBy(F.desc("score"), id_col).limit(k)


def history_documents(tickets: DataFrame, events: DataFrame, billing: DataFrame) -> DataFrame:
    """(source, doc_id, scope, at, doc): tickets, bill disputes and node events as texts."""
    return (
        tickets.select(F.lit("ticket").alias("source"), F.col("ticket_id").alias("doc_id"),
                       F.col("subscriber_id").alias("scope"), F.col("opened_date").alias("at"),
                       F.concat_ws(" ", "ticket_type", "note_text").alias("doc"))
        .unionByName(billing.filter("dispute_reason IS NOT NULL").select(
            F.lit("bill").alias("source"), F.col("bill_id").alias("doc_id"), F.col("subscriber_id").alias("scope"),
            F.col("bill_month").alias("at"), F.concat(F.lit("dispute "), F.col("dispute_reason")).alias("doc")))
        .unionByName(events.select(
            F.lit("event").alias("source"), F.col("event_id").alias("doc_id"), F.col("node_id").alias("scope"),
            F.col("event_date").alias("at"), F.concat(F.lit("network "), F.col("event_type")).alias("doc"))))


def history_search(tickets: DataFrame, events: DataFrame, billing: DataFrame, who: DataFrame,
                   query: str, k: int, subscriber_id: str | None = None) -> DataFrame:
    """Best hits in each subscriber's service history: tickets, bill disputes, node events.

    With a ``subscriber_id`` the three sources are pruned to that subscriber and their node first, and the corpus of
    the scores is their history.

    Hits are cut to k per subscriber and per node before nodes are spread to
    their subscribers, so a node with many subscribers never multiplies its
    whole event history.
    """
    if subscriber_id is not None:
        who = who.filter(F.col("subscriber_id") == subscriber_id)
        own, nodes = F.col("subscriber_id") == subscriber_id, who.select(F.col("service_node_id").alias("node_id"))
        tickets, billing, events = tickets.filter(own), billing.filter(own), events.join(nodes, "node_id", "left_semi")
    docs = history_documents(tickets, events, billing)
    hits = bm25_scores(docs, "doc", query, ["source", "doc_id", "scope", "at"])
    order = [F.desc("score"), F.desc("at"), F.asc("doc_id")]
    best = top_per_key(hits, ["scope"], order, k).drop("rank")
    scopes = who.select("subscriber_id", F.explode(F.array("subscriber_id", "service_node_id")).alias("scope"))
    return top_per_key(scopes.join(best, "scope").drop("scope"), ["subscriber_id"], order, k)


def offer_search(notes: DataFrame, offers: DataFrame, k: int) -> DataFrame:
    """Offers that best match each distinct note: every note is a query over the catalog.

    Notes are made distinct with their count first; BM25 weights exist once per
    catalog word, so a note only joins the words it holds.
    """
    asked = notes.groupBy("note_text").agg(F.count(F.lit(1)).alias("n_tickets"))
    entries = offers.filter("is_active").select(
        "offer_id", X.search_words(F.concat_ws(" ", "offer_name", "description")).alias("w"))
    stats = entries.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg(F.size("w")).alias("len")).alias("s")).scalar()
    per_word = (entries.select("offer_id", F.size("w").alias("len"), F.explode("w").alias("word"))
                .groupBy("offer_id", "len", "word").agg(F.count(F.lit(1)).alias("tf")))
    df = per_word.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weighted = per_word.join(df, "word").withColumn("s", stats)
    idf = F.log(1 + (F.col("s.n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("s.len")))
    words = asked.select("note_text", "n_tickets", F.explode(F.array_distinct(X.search_words(F.col("note_text")))).alias("word"))
    scored = (words.join(weighted.select("word", "offer_id", weight.alias("weight")), "word")
              .groupBy("note_text", "n_tickets", "offer_id").agg(F.round(F.sum("weight"), 6).alias("score")))
    return top_per_key(scored, ["note_text"], [F.desc("score"), F.asc("offer_id")], k)


def vector_topk(vectors: DataFrame, query: DataFrame, k: int = 10) -> DataFrame:
    """Exact cosine neighbours of one query vector (a frame with a single ``embedding`` row)."""
    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                           F.lit(0.0), lambda acc, v: acc + v)
    q = query.select(F.col("embedding")).scalar()
    v = F.col("embedding")
    cosine = dot(v, F.col("q")) / (F.sqrt(dot(v, v)) * F.sqrt(dot(F.col("q"), F.col("q"))))
    return (vectors.withColumn("q", q).select("vec_id", "label", F.round(cosine, 6).alias("cosine"))
            .orderBy(F.desc("cosine"), "vec_id").limit(k))


def note_classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(id_col, X.anger_score(F.col(text_col)).alias("anger_score"))
