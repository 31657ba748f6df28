"""Queries on selection, pairing, batches, head fitting and evaluation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from acoustic_spark.config import NEGATIVE_CLASSES, POSITIVE_CLASSES
from acoustic_spark.operators import pairing, scoring
from acoustic_spark.operators.pairing import label_vector
from acoustic_spark.plans import head, training
from acoustic_spark.plans.queries_features import PATCHES, arrow_patches, big
from acoustic_spark.plans.queries_scoring import PROJECTION, QUANTISED, label_head, quantised_column
from acoustic_spark.plans.registry import query
from acoustic_spark.plans.tables import read
from acoustic_spark.sources.dimensions import append_metrics
from acoustic_spark.workspace import shared_folder

WANTED = ("en", "fr", "src3")
PER_CLASS = 40


@query(
    "balanced_selection",
    f"""SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr') OR source IN ('src3')
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= {PER_CLASS}""",
)
def balanced_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Clips with a wanted label, the same number from each subclass."""
    meta = read(spark, sf, "documents").select("doc_id", "lang", "source")
    wanted = pairing.with_any_label(meta, F.array("lang", "source"), WANTED)
    return pairing.balanced(wanted, "lang", "doc_id", PER_CLASS).select("doc_id", "lang")


# Labels of the configured sets for documents: one by language, one by source, one by length.
SETS = [*POSITIVE_CLASSES, *NEGATIVE_CLASSES]
PER_POSITIVE, PER_NEGATIVE = 25, 15
_NAMES = ", ".join(f"'{c}'" for c in SETS)


def _rounds(side: str, classes: tuple[str, ...], n: int) -> str:
    """SQL of the rounds of a selection over carried(seq, label): tables {side}_all<r>, one round more than there are classes."""
    order = ", ".join(f"('{c}', {i})" for i, c in enumerate(classes))
    parts = [f"""{side}_c AS MATERIALIZED (SELECT c.seq, c.label, o.pos, count(*) OVER (PARTITION BY c.label) AS n
  FROM carried c JOIN (VALUES {order}) o(label, pos) USING (label) WHERE c.positive = {side == 'p'}),
{side}_all0 AS (SELECT seq, label FROM {side}_c WHERE false)"""]
    for r in range(1, len(classes) + 2):
        parts.append(f"""{side}_s{r} AS MATERIALIZED (SELECT label, {n} - count(a.seq) AS short FROM (SELECT DISTINCT label FROM {side}_c) l LEFT JOIN {side}_all{r - 1} a USING (label) GROUP BY label),
{side}_h{r} AS (SELECT c.seq, c.label, s.short FROM {side}_c c JOIN {side}_s{r} s USING (label) WHERE short > 0 AND c.seq NOT IN (SELECT seq FROM {side}_all{r - 1})
  QUALIFY row_number() OVER (PARTITION BY c.seq ORDER BY c.n, c.pos) = 1),
{side}_all{r} AS MATERIALIZED (SELECT * FROM {side}_all{r - 1} UNION ALL
  SELECT seq, label FROM (SELECT * FROM {side}_h{r} QUALIFY row_number() OVER (PARTITION BY label ORDER BY seq) <= short))""")
    return ",\n".join(parts)


@query(
    "training_selection",
    f"""WITH names AS (SELECT [{_NAMES}] AS l),
labelled AS (SELECT doc_id AS seq, list_distinct([l[1 + ascii(lang) % {len(SETS)}], l[1 + ascii(right(source, 1)) % {len(SETS)}], l[1 + n_chars % {len(SETS)}]]) AS labels FROM documents, names),
carried AS MATERIALIZED (SELECT seq, unnest(labels) AS label, len(list_intersect(labels, l[1:{len(POSITIVE_CLASSES)}])) > 0 AS positive FROM labelled, names WHERE labels IS NOT NULL),
{_rounds('p', POSITIVE_CLASSES, PER_POSITIVE)},
{_rounds('n', NEGATIVE_CLASSES, PER_NEGATIVE)}
SELECT seq AS doc_id, label, 1::BIGINT AS positive FROM p_all{len(POSITIVE_CLASSES) + 1} UNION ALL
SELECT seq, label, 0::BIGINT FROM n_all{len(NEGATIVE_CLASSES) + 1}""",
)
def training_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Both training sets by the configured classes from documents with up to three labels, each document once."""
    names = F.array(*[F.lit(c) for c in SETS])
    pick = lambda number: F.element_at(names, (F.pmod(number, F.lit(len(SETS))) + 1).cast("int"))
    labels = F.array_compact(F.array(pick(F.ascii("lang")), pick(F.ascii(F.substring("source", -1, 1))), pick(F.col("n_chars"))))
    meta = read(spark, sf, "documents").select(F.col("doc_id").alias("seq"), labels.alias("labels"))
    chosen = pairing.training_sets(meta, F.col("labels"), "seq", PER_POSITIVE, PER_NEGATIVE)
    return chosen.select(F.col("seq").alias("doc_id"), "label", *big("positive"))


def sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    labels = read(spark, sf, "labels").select("doc_id", "quality")
    return labels.filter(F.col("quality") == 1), labels.filter(F.col("quality") == 0)


PAIRS = """pos AS (SELECT doc_id AS pos_id, row_number() OVER (ORDER BY doc_id) - 1 AS rank FROM labels WHERE quality = 1),
neg AS (SELECT doc_id AS neg_id, row_number() OVER (ORDER BY doc_id) - 1 AS rank FROM labels WHERE quality = 0)"""


@query("paired_examples", f"WITH {PAIRS} SELECT CAST(rank AS BIGINT) AS rank, pos_id, neg_id FROM pos JOIN neg USING (rank)")
def paired_examples(spark: SparkSession, sf: str) -> DataFrame:
    pairs, _ = pairing.pair_by_position(*sides(spark, sf), "doc_id")
    return pairs.select(*big("rank"), "pos_id", "neg_id")


@query(
    "paired_paths",
    """WITH paths AS (SELECT '/clips/' || doc_id || '.wav' AS path, quality FROM labels),
pos AS (SELECT path AS pos_id, row_number() OVER (ORDER BY path) - 1 AS rank FROM paths WHERE quality = 1),
neg AS (SELECT path AS neg_id, row_number() OVER (ORDER BY path) - 1 AS rank FROM paths WHERE quality = 0)
SELECT CAST(rank AS BIGINT) AS rank, pos_id, neg_id FROM pos JOIN neg USING (rank)""",
)
def paired_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of file paths, in the order of the paths."""
    path = F.concat(F.lit("/clips/"), "doc_id", F.lit(".wav")).alias("path")
    pairs, _ = pairing.pair_by_position(*[side.select(path) for side in sides(spark, sf)], "path")
    return pairs.select(*big("rank"), "pos_id", "neg_id")


@query(
    "unpaired_positives",
    f"WITH {PAIRS} SELECT CAST(rank AS BIGINT) AS rank, pos_id FROM pos WHERE rank NOT IN (SELECT rank FROM neg)",
)
def unpaired_positives(spark: SparkSession, sf: str) -> DataFrame:
    _, unpaired = pairing.pair_by_position(*sides(spark, sf), "doc_id")
    return unpaired.select(*big("rank"), "pos_id")


@query("label_vectors", "SELECT doc_id, CAST(quality AS BIGINT) AS pos, CAST(1 - quality AS BIGINT) AS neg FROM labels")
def label_vectors(spark: SparkSession, sf: str) -> DataFrame:
    vector = label_vector(F.col("quality") == 1)
    return read(spark, sf, "labels").select(
        "doc_id", vector[0].cast("bigint").alias("pos"), vector[1].cast("bigint").alias("neg")
    )


CONCATENATED = """SELECT doc_id, CAST(quality AS BIGINT) AS quality, CAST(quality AS BIGINT) AS pos,
       CAST(1 - quality AS BIGINT) AS neg FROM labels"""


def _labelled(rows: DataFrame, *carried: str) -> DataFrame:
    return rows.select(
        "doc_id", *big("quality", *carried), F.col("labels")[0].cast("bigint").alias("pos"), F.col("labels")[1].cast("bigint").alias("neg")
    )


@query("concatenated_examples", CONCATENATED)
def concatenated_examples(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(pairing.concatenate(*sides(spark, sf)))


@query("shuffled_examples", f"SELECT *, CAST(row_number() OVER (ORDER BY md5(doc_id || ':7'), doc_id) - 1 AS BIGINT) AS rank FROM ({CONCATENATED})")
def shuffled_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Both sets in seeded random order, the place of each example as its rank."""
    ranked = pairing.shuffled_ranks(pairing.concatenate(*sides(spark, sf)), 7, "doc_id")
    return _labelled(ranked, "rank")


@query(
    "mixed_batches",
    f"""WITH {PATCHES}, kinds AS (
  SELECT user_id AS sensor_id, arg_min(event_type, event_id) IN ('click', 'view') AS positive FROM events GROUP BY ALL),
examples AS (SELECT DISTINCT sensor_id, example, positive FROM patches JOIN kinds USING (sensor_id)),
pos AS (SELECT sensor_id AS p, row_number() OVER (ORDER BY sensor_id) - 1 AS batch_id FROM examples WHERE positive GROUP BY sensor_id),
neg AS (SELECT sensor_id AS q, row_number() OVER (ORDER BY sensor_id) - 1 AS batch_id FROM examples WHERE NOT positive GROUP BY sensor_id),
pairs AS (SELECT * FROM pos JOIN neg USING (batch_id))
SELECT CAST(batch_id AS BIGINT) AS batch_id, sensor_id, CAST(example AS BIGINT) AS example,
       CAST(CASE WHEN sensor_id = p THEN 1 ELSE 0 END AS BIGINT) AS pos
FROM pairs JOIN examples ON sensor_id IN (p, q)""",
)
def mixed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of paired sensors; the kind of a sensor's first event makes it a positive or a negative."""
    first_type = F.min_by("event_type", "event_id")
    kinds = (
        read(spark, sf, "events")
        .groupBy(F.col("user_id").alias("sensor_id"))
        .agg(first_type.isin("click", "view").cast("int").alias("positive"))
    )
    folder = shared_folder(spark, "patches")
    # Features are computed once and stored: the pairing reads them several times.
    arrow_patches(spark, sf).join(kinds, "sensor_id").write.partitionBy("positive").parquet(folder)
    examples = spark.read.parquet(folder)
    positives = examples.filter(F.col("positive") == 1).drop("positive")
    negatives = examples.filter(F.col("positive") == 0).drop("positive")
    mixed = pairing.mixed_batches(positives, negatives, "sensor_id", seed=7)
    return mixed.select(*big("batch_id"), "sensor_id", *big("example"), F.col("labels")[0].cast("bigint").alias("pos"))


def labelled_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings with the label vector of their document."""
    labels = read(spark, sf, "labels").select(F.col("doc_id").alias("vec_id"), "quality")
    return (
        read(spark, sf, "embeddings")
        .select("vec_id", "embedding")
        .join(labels, "vec_id")
        .withColumn("labels", label_vector(F.col("quality") == 1))
    )


FIT = head.HeadConfig(hidden=4, steps=2, learning_rate=0.01)
FIT_EXAMPLES = """x AS MATERIALIZED (
  SELECT vec_id AS id, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels)),
y AS MATERIALIZED (SELECT doc_id AS id, c, CASE WHEN c = 0 THEN quality ELSE 1 - quality END AS t FROM labels, range(2) r(c))"""


@query(
    "head_fit",
    f"""WITH {head.fit_sql(FIT_EXAMPLES, 64, FIT, 2)}
SELECT id AS vec_id, round(1 / (1 + exp(-max(CASE WHEN c = 0 THEN z END))), 6) AS positive, round(1 / (1 + exp(-max(CASE WHEN c = 1 THEN z END))), 6) AS negative
FROM z2 GROUP BY id""",
)
def head_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Both outputs for every labelled embedding after two steps over all of them."""
    examples = labelled_embeddings(spark, sf)
    fitted = head.fit_head(examples, shared_folder(spark, "head"), 1, FIT)
    scores = examples.withColumn("scores", scoring.dense(F.col("embedding"), *fitted.layers()))
    return scores.select("vec_id", *[F.round(F.col("scores")[c], 6).alias(name) for c, name in enumerate(("positive", "negative"))])


RESUME = replace(FIT, steps=1)
LOSSES = " UNION ALL ".join(f"SELECT {t}::INT AS epoch, {t}::BIGINT AS step, round(loss, 9) AS loss FROM loss{t}" for t in range(4))


@query("head_resume", f"WITH {head.fit_sql(FIT_EXAMPLES, 64, RESUME, 3)} {LOSSES}")
def head_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Losses of a fit of one epoch that is then taken up twice from what it saved: those of a fit in one go."""
    examples = labelled_embeddings(spark, sf)
    folder = shared_folder(spark, "head")
    for epochs in (1, 3, 4):
        head.fit_head(examples, folder, epochs, RESUME)
    append_metrics(head.loss_rows(spark, folder), f"{folder}/metrics", every=1)
    return spark.read.parquet(f"{folder}/metrics").withColumn("loss", F.round("loss", 9))


@query(
    "evaluation_embeddings",
    f"""WITH {QUANTISED}
SELECT q.vec_id, CAST(quality AS BIGINT) AS label, CAST(o AS BIGINT) AS o, q
FROM quantised q JOIN labels ON q.vec_id = doc_id""",
)
def evaluation_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Projected and quantised embeddings of both evaluation sets."""
    examples = labelled_embeddings(spark, sf)
    positives, negatives = examples.filter(F.col("quality") == 1), examples.filter(F.col("quality") == 0)
    rows = training.labelled_embeddings(positives, negatives, quantised_column(spark, sf))
    return rows.select("vec_id", *big("label"), F.posexplode("embedding").alias("o", "q")).select(
        "vec_id", "label", *big("o", "q")
    )


@query(
    "evaluation_counts",
    f"""WITH {PROJECTION}, scored AS (
  SELECT vec_id, sum(w * x) AS z FROM cells JOIN pca USING (i) WHERE o = 0 GROUP BY vec_id)
SELECT CAST(quality AS BIGINT) AS label, CAST(1 / (1 + exp(-z)) > 0.5 AS BIGINT) AS predicted, CAST(count(*) AS BIGINT) AS n
FROM scored JOIN labels ON vec_id = doc_id GROUP BY ALL""",
)
def evaluation_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Both evaluation sets scored and counted by label and prediction."""
    examples = labelled_embeddings(spark, sf)
    positives, negatives = examples.filter(F.col("quality") == 1), examples.filter(F.col("quality") == 0)
    score = scoring.dense(F.col("embedding"), label_head(spark, sf))[0]
    return training.evaluate(positives, negatives, score).select(*big("label", "predicted", "n"))
