"""Queries over embeddings, texts and document snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan.operators import facts, policies, retrieval, snapshots
from tallyspan.plans.registry import query
from tallyspan.plans.sessions import REDACTED, words_sql
from tallyspan.storage import shared_folder
from tallyspan.streaming.index import incremental_index

_AXES = """
x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
        generate_subscripts(embedding, 1) AS i FROM embeddings)"""


def _docs(t):
    return t.read("embeddings").withColumnRenamed("vec_id", "doc_id")


def _mean_vector(t):
    whole = retrieval.centroids(_docs(t).withColumn("all", F.lit(0)), "all", "embedding")
    return whole.first()["centroid"]


def _questions(t):
    """One question per label: the mean of its vectors."""
    return retrieval.centroids(_docs(t), "label", "embedding").select(
        F.col("label").alias("question_id"), F.col("centroid").alias("question")
    )


def _rounded(df):
    return df.withColumn("score", F.round("score", 6))


@query("similarity_topk", sql=f"""
WITH {_AXES}, q AS (SELECT list(m ORDER BY i) AS q FROM (SELECT i, avg(x) AS m FROM x GROUP BY 1)),
s AS (SELECT vec_id AS doc_id, round(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])), 9)
        AS score FROM embeddings, q)
SELECT doc_id, round(score, 6) AS score, CAST(row_number() OVER (ORDER BY score DESC, doc_id)
  AS INTEGER) AS rank FROM s QUALIFY rank <= 3""")
def _(t):
    return _rounded(retrieval.similarity_topk(_docs(t), _mean_vector(t), 3))


_BY_LABEL = f"""
WITH {_AXES}, q AS (SELECT label AS question_id, list(m ORDER BY i) AS q
  FROM (SELECT label, i, avg(x) AS m FROM x GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT question_id, vec_id AS doc_id,
        round(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])), 9) AS score
      FROM embeddings, q),
k AS (SELECT question_id, doc_id, round(score, 6) AS score, CAST(row_number() OVER
  (PARTITION BY question_id ORDER BY s.score DESC, doc_id) AS INTEGER) AS rank FROM s
  QUALIFY rank <= 3)
"""


@query("question_doc_topk", sql=_BY_LABEL + "SELECT * FROM k")
def _(t):
    return _rounded(retrieval.question_doc_topk(_questions(t), _docs(t), 3))


@query("similarity_topk_lsh", sql="SELECT 3 AS found, true AS close")
def _(t):
    """The approximate best three held against the exact ones: one of them may be missed."""
    rough = retrieval.similarity_topk_lsh(retrieval.lsh_table(_docs(t)), _mean_vector(t), 3)
    exact = retrieval.similarity_topk(_docs(t), _mean_vector(t), 3)
    both = rough.select("doc_id", "rank").join(
        exact.select("doc_id", F.lit(1).alias("_exact")), "doc_id", "left")
    return both.agg(
        F.count("rank").cast("int").alias("found"),
        (F.count("_exact") >= 2).alias("close"),
    )


def _counted_sql(source, key):
    return f"""SELECT id, w, count(*) AS n FROM (
      SELECT {key} AS id, unnest({words_sql('text')}) AS w FROM {source}) GROUP BY 1, 2"""


def _searched(head, source, last, k=3):
    """SQL of the best k documents of ``source`` for every benchmark item, as relation ``best``."""
    return f"""{head}
dc AS ({_counted_sql(source, 'doc_id')}), qc AS ({_counted_sql('benchmark', 'item_id')}),
t AS (SELECT count(*) AS total FROM {source}),
idf AS (SELECT w, ln(any_value(total) + 1.0) - ln(count(*) + 1.0) AS g FROM dc, t GROUP BY 1),
dw AS (SELECT id, w, n * g AS x FROM dc JOIN idf USING (w)),
qw AS (SELECT id, w, n * coalesce(g, ln(total + 1.0)) AS x FROM qc LEFT JOIN idf USING (w), t),
dn AS (SELECT id, sqrt(sum(x * x)) AS norm FROM dw GROUP BY 1),
qn AS (SELECT id, sqrt(sum(x * x)) AS norm FROM qw GROUP BY 1),
s AS (SELECT q.id AS question_id, d.id AS doc_id,
        round(sum(q.x * d.x) / any_value(qn.norm) / any_value(dn.norm), 9) AS score
      FROM qw q JOIN dw d USING (w) JOIN qn ON qn.id = q.id JOIN dn ON dn.id = d.id
      WHERE qn.norm > 0 AND dn.norm > 0 GROUP BY 1, 2),
best AS (SELECT question_id, doc_id, round(score, 6) AS score, CAST(row_number() OVER (
    PARTITION BY question_id ORDER BY s.score DESC, doc_id) AS INTEGER) AS rank
  FROM s WHERE score > 0 QUALIFY rank <= {k})
{last}"""


@query("text_topk", sql=_searched("WITH", "documents", "SELECT * FROM best"))
def _(t):
    asked = t.read("benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )
    return _rounded(retrieval.text_topk(asked, t.read("documents"), 3))


# The fact table's categories; the labels of the documents take turns with them.
_TOPICS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("data_plus_docs", sql=_BY_LABEL + f""",
f AS (SELECT c_mktsegment AS topic, sum(o_custkey * 100) AS affected_population
      FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT topic, question_id, CAST(affected_population AS BIGINT) AS affected_population, doc_id,
  score, rank
FROM f JOIN (SELECT *, list_extract({_TOPICS}, question_id % 5 + 1) AS topic FROM k)
  USING (topic)""")
def _(t):
    summary = facts.sum_by_category(t.fact).withColumnRenamed("disaster_type", "topic")
    names = F.array(*[F.lit(name) for name in _TOPICS])
    hits = _rounded(retrieval.question_doc_topk(_questions(t), _docs(t), 3)).withColumn(
        "topic", F.get(names, F.col("question_id") % len(_TOPICS))
    )
    return retrieval.data_plus_docs(summary, hits, "topic")


# -- snapshots: the documents before and after cleaning ----------------------


def _cleaned(t):
    """Documents labelled toxic are gone, personal data is masked, benchmark items are new."""
    toxic = t.read("labels").filter(F.col("toxic") == 1).select("doc_id")
    if toxic.limit(snapshots.SENT_KEYS + 1).count() <= snapshots.SENT_KEYS:
        toxic = F.broadcast(toxic)
    kept = t.read("documents").select("doc_id", "text").join(toxic, "doc_id", "left_anti")
    added = t.read("benchmark").select((-1 - F.col("item_id")).alias("doc_id"), "text")
    return policies.pii_redact(kept, "text").unionByName(added)


_CLEANED = f"""
WITH {REDACTED}, new AS (SELECT doc_id, text FROM redacted
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)
  UNION ALL SELECT -1 - item_id, text FROM benchmark)
"""


@query("snapshot_diff", sql=_CLEANED + """
SELECT doc_id, CASE WHEN o.text IS NULL THEN 'inserted' WHEN n.text IS NULL THEN 'deleted'
  ELSE 'updated' END AS change
FROM documents o FULL JOIN new n USING (doc_id) WHERE o.text IS DISTINCT FROM n.text""")
def _(t):
    return snapshots.snapshot_diff(t.read("documents"), _cleaned(t), "doc_id", "text")


def _index(t):
    """The documents are indexed, then the changes up to the cleaned snapshot."""
    path = shared_folder(t.spark, "index")
    old = t.read("documents").select("doc_id", "text")
    everything = old.select("doc_id", F.lit("inserted").alias("change"), "text")
    changes = snapshots.changed_documents(old, _cleaned(t), "doc_id", "text")
    for arrived in (everything, changes):
        arrived.write.mode("append").option("compression", "zstd").parquet(f"{path}/changes")
        source = t.spark.readStream.schema(everything.schema).parquet(f"{path}/changes")
        incremental_index(source, path).awaitTermination()
    return snapshots.read_index(t.spark, f"{path}/entries", "doc_id")


@query("incremental_index", sql=_CLEANED + f"""
SELECT doc_id, CAST(len({words_sql('text')}) AS INTEGER) AS words FROM new""")
def _(t):
    return _index(t).select("doc_id", F.size("terms").alias("words"))


@query("index_search", sql=_searched(_CLEANED.rstrip() + ",", "new", "SELECT * FROM best"))
def _(t):
    """Benchmark items searched in the index as it stands after two syncs."""
    index = _index(t).withColumnRenamed("terms", "_terms")
    asked = t.read("benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )
    return _rounded(retrieval.text_topk(asked, index, 3, terms="_terms"))


@query("predict_by_search", sql=_searched("WITH", "documents", """
SELECT item_id AS question_id, doc_id, d.text AS answer
FROM benchmark b LEFT JOIN best ON question_id = item_id LEFT JOIN documents d USING (doc_id)""", 1))
def _(t):
    asked = t.read("benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )
    return retrieval.answers_from_search(asked, t.read("documents")).drop("question")
