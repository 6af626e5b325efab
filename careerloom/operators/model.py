"""Naive-Bayes models per sector and year, scoring, voting and evaluation.

A model asks whether a person of a sector holds two or more positions at once
in a year (YES) or exactly one (NO). Features are the connection count and the
experience (Gaussian), and a flag per top tag of the sector (nominal); see
John & Langley 1995 for the mix. The sector itself is a nominal feature too: it
is the same for all rows of a model, but its smoothed likelihood differs by
class, so it stays in the sum.

All a model needs is counts and moments, so all models come from one
aggregation by (sector, year, label) with partial aggregates, whatever the size
of a sector. Scoring joins one row per sector to the test rows and votes inside
the row, so test rows are not multiplied. They are not shuffled either if the small side
is a written table: then Spark knows its size and broadcasts it.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerloom.functions import clean_tag, connection_count
from careerloom.operators.sectors import require_sector, valid_sector
from careerloom.schema import NO, SECTORS, TEST_YEAR, TOP_K, YES

# Smallest standard deviation of a Gaussian feature.
SIGMA_FLOOR = 1.0 / 6.0
# Log-likelihoods closer than this are equal, whatever order sums were taken in.
TIE_TOLERANCE = 1e-9


def tag_columns(k: int = TOP_K) -> list[str]:
    return [f"tag_{i}" for i in range(1, k + 1)]


def attach_top_tags(df: DataFrame, top_tags: DataFrame, sector_col: str = "sector") -> DataFrame:
    """Add ``tags``, the top tags of each row's sector; an empty list without any.

    One row per sector on the small side. Give it as a written table: of an aggregate, Spark
    only knows the size of what lies below it, and may shuffle ``df`` by sector.
    """
    tags = top_tags.select(F.col("sector").alias("_sector"), F.col("tags").alias("_tags"))
    return (
        df.join(tags, F.col(sector_col) == F.col("_sector"), "left")
        .withColumn("tags", F.coalesce("_tags", F.array().cast("array<string>")))
        .drop("_sector", "_tags")
    )


def label_multi_position(panel: DataFrame) -> DataFrame:
    """Add ``label``: YES with two or more active positions, NO with one, else null."""
    active = F.size("positions")
    return panel.withColumn("label", F.when(active >= 2, F.lit(YES)).when(active == 1, F.lit(NO)))


def feature_columns(
    df: DataFrame,
    top_tags: DataFrame,
    k: int = TOP_K,
    normalize: bool = False,
    sector_col: str = "sector",
) -> DataFrame:
    """Replace skills and connections by features: ``connections`` and ``tag_1..tag_k``.

    A flag is 1 when the skills, as written, hold the sector's i-th tag, else 0;
    null where the sector has fewer tags. ``normalize`` cleans the skills first.
    These depend on the person only: add them before unfolding years.
    """
    skills = F.transform("skills", clean_tag) if normalize else F.col("skills")
    flags = []
    for i, name in enumerate(tag_columns(k)):
        tag = F.get("tags", F.lit(i))
        has = F.coalesce(F.array_contains(skills, tag), F.lit(False)).cast("int")
        flags.append(F.when(tag.isNotNull(), has).alias(name))
    kept = [c for c in df.columns if c not in ("skills", "num_connections")]
    return attach_top_tags(df, top_tags, sector_col).select(
        *kept, connection_count(F.col("num_connections")).alias("connections"), *flags
    )


def feature_rows(
    panel: DataFrame,
    top_tags: DataFrame,
    k: int = TOP_K,
    normalize: bool = False,
    id_col: str = "pid",
    sector_col: str = "sector",
) -> DataFrame:
    """(id, sector, year, connections, experience, tag flags, label) per panel row."""
    if "connections" not in panel.columns:
        panel = feature_columns(panel, top_tags, k, normalize, sector_col)
    return label_multi_position(panel).select(
        id_col,
        F.col(sector_col).alias("sector"),
        "year",
        "connections",
        F.col("relevant_experience").alias("experience"),
        *tag_columns(k),
        "label",
    )


def split_by_year(
    rows: DataFrame, test_year: int = TEST_YEAR, train_before_only: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(training rows, test rows). Training takes all other years, later ones too.

    ``train_before_only`` keeps only the years before the test year.
    """
    year = F.col("year")
    train = year < test_year if train_before_only else year != test_year
    return rows.filter(train), rows.filter(year == test_year)


def moment_aggregates(k: int = TOP_K) -> list[Column]:
    """Counts and moments that make up one class of a model."""
    return [
        F.count("*").alias("n_rows"),
        F.avg("connections").alias("mean_connections"),
        F.stddev_pop("connections").alias("sd_connections"),
        F.avg("experience").alias("mean_experience"),
        F.stddev_pop("experience").alias("sd_experience"),
        F.array(*[F.sum(name) for name in tag_columns(k)]).alias("tag_counts"),
    ]


def train_sector_year_nb(
    train: DataFrame, k: int = TOP_K, sectors: Iterable[str] = SECTORS
) -> DataFrame:
    """Model table: one row per (sector, model_year, label) with counts and moments.

    Rows without a label or with a sector outside the vocabulary are not used.
    ``tag_counts`` holds the rows with each tag, null where there is no such tag.
    """
    return (
        valid_sector(train, "sector", sectors)
        .filter(F.col("label").isNotNull())
        .groupBy("sector", F.col("year").alias("model_year"), "label")
        .agg(*moment_aggregates(k))
    )


def _merged_moments(a: Column, b: Column) -> Column:
    """Moments of two sets of rows together (the pairwise update of Chan, Golub and LeVeque)."""
    n = a["n_rows"] + b["n_rows"]

    def together(name: str) -> list[Column]:
        apart = b[f"mean_{name}"] - a[f"mean_{name}"]
        mean = a[f"mean_{name}"] + apart * b["n_rows"] / n
        squares = sum((m["n_rows"] * m[f"sd_{name}"] * m[f"sd_{name}"] for m in (a, b)), F.lit(0.0))
        squares += apart * apart * a["n_rows"] * b["n_rows"] / n
        return [mean.alias(f"mean_{name}"), F.sqrt(squares / n).alias(f"sd_{name}")]

    return F.struct(
        n.alias("n_rows"),
        *together("connections"),
        *together("experience"),
        F.zip_with(a["tag_counts"], b["tag_counts"], lambda x, y: x + y).alias("tag_counts"),
    )


def merge_models(*models: DataFrame) -> DataFrame:
    """One model table from those of several batches of people or years, as if all had been trained at once.

    Only counts and moments are read, a row for each class of a model and batch. All batches must have been trained with the same
    top tags; a tag that one of them lacks is null in the result. Means and deviations agree with those of one training
    up to rounding, whatever the order.
    """
    keys = ["sector", "model_year", "label"]
    moments = F.struct(
        "n_rows", "mean_connections", "sd_connections", "mean_experience", "sd_experience", "tag_counts"
    )
    rows = reduce(DataFrame.unionByName, [m.select(*keys, moments.alias("_m")) for m in models])
    merged = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("_m")).alias("_all"))
    return merged.select(
        *keys, F.reduce(F.slice("_all", 2, len(models)), F.get("_all", F.lit(0)), _merged_moments).alias("_m")
    ).select(*keys, "_m.*")


def _class_parameters(vocabulary_size: int) -> Column:
    """What scoring needs of one class: constant term, Gaussians, weight per tag."""
    n = F.col("n_rows").cast("double")
    sd_connections = F.greatest("sd_connections", F.lit(SIGMA_FLOOR))
    sd_experience = F.greatest("sd_experience", F.lit(SIGMA_FLOOR))
    without_tags = F.aggregate(
        "tag_counts",
        F.lit(0.0),
        lambda total, count: total + F.coalesce(F.log((n - count + 1) / (n + 2)), F.lit(0.0)),
    )
    return F.struct(
        (
            F.log(n + 1)
            - F.log(sd_connections)
            - F.log(sd_experience)
            + F.log((n + 1) / (n + vocabulary_size))
            + without_tags
        ).alias("base"),
        F.col("mean_connections").alias("mean_connections"),
        sd_connections.alias("sd_connections"),
        F.col("mean_experience").alias("mean_experience"),
        sd_experience.alias("sd_experience"),
        F.transform(
            "tag_counts",
            lambda count: F.coalesce(F.log((count + 1) / (n - count + 1)), F.lit(0.0)),
        ).alias("tag_weights"),
    )


def sector_models(models: DataFrame, vocabulary_size: int = len(SECTORS)) -> DataFrame:
    """(sector, models): all models of a sector as one list, a struct per year.

    A sector has at most one model per year, so the list is short.
    """
    parameters = models.select("sector", "model_year", "label", _class_parameters(vocabulary_size).alias("_p"))
    by_year = parameters.groupBy("sector", "model_year").agg(
        F.max(F.when(F.col("label") == YES, F.col("_p"))).alias("yes"),
        F.max(F.when(F.col("label") == NO, F.col("_p"))).alias("no"),
    )
    return by_year.groupBy("sector").agg(
        F.sort_array(F.collect_list(F.struct("model_year", "yes", "no"))).alias("models")
    )


def score_join(test: DataFrame, by_sector: DataFrame) -> DataFrame:
    """Add to each test row the ``models`` of its sector; null where there are none."""
    return test.join(by_sector, "sector", "left")


def _log_likelihood(p: Column, k: int) -> Column:
    connections = (F.col("connections") - p["mean_connections"]) / p["sd_connections"]
    experience = (F.col("experience") - p["mean_experience"]) / p["sd_experience"]
    score = p["base"] - (connections * connections + experience * experience) / 2
    for i, name in enumerate(tag_columns(k)):
        score = score + F.when(F.col(name) == 1, F.get(p["tag_weights"], F.lit(i))).otherwise(0.0)
    return score


def _says_no(model: Column, k: int, tie_tolerance: float) -> Column:
    """Whether a model picks NO. A class without training rows cannot win; a tie is YES."""
    margin = _log_likelihood(model["no"], k) - _log_likelihood(model["yes"], k)
    return F.when(model["no"].isNull(), F.lit(False)).otherwise(
        F.coalesce(margin > tie_tolerance, F.lit(True))
    )


def score_nb(
    test: DataFrame, by_sector: DataFrame, k: int = TOP_K, tie_tolerance: float = TIE_TOLERANCE
) -> DataFrame:
    """One row per test row and model of its sector, with the ``predicted`` class."""
    scored = score_join(test, by_sector).select(
        *test.columns, F.explode("models").alias("_model")
    )
    return scored.select(
        *test.columns,
        F.col("_model.model_year").alias("model_year"),
        F.when(_says_no(F.col("_model"), k, tie_tolerance), F.lit(NO)).otherwise(F.lit(YES)).alias("predicted"),
    )


def vote(
    test: DataFrame, by_sector: DataFrame, k: int = TOP_K, tie_tolerance: float = TIE_TOLERANCE
) -> DataFrame:
    """Add ``votes`` and ``predicted``: +1 per model that says NO, -1 per YES.

    NO wins with a positive sum; a tie, or no model at all, is YES.
    """
    votes = F.aggregate(
        "models",
        F.lit(0),
        lambda total, model: total + F.when(_says_no(model, k, tie_tolerance), F.lit(1)).otherwise(F.lit(-1)),
    )
    return (
        score_join(test, by_sector)
        .select(*test.columns, F.coalesce(votes, F.lit(0)).alias("votes"))
        .withColumn("predicted", F.when(F.col("votes") > 0, F.lit(NO)).otherwise(F.lit(YES)))
    )


def _weight(weight_col: str | None) -> Column:
    return F.lit(1) if weight_col is None else F.col(weight_col)


def confusion_counts(
    predictions: DataFrame, positive: str = NO, weight_col: str | None = None
) -> DataFrame:
    """One row with the four cells over the labelled rows.

    ``positive`` is the class counted as positive: NO is the customary output,
    YES reads the table as "holds several positions". ``weight_col`` gives the
    number of people a row stands for.
    """
    actual, predicted = F.col("label") == positive, F.col("predicted") == positive

    def cell(condition: Column, name: str) -> Column:
        hits = F.sum(F.when(condition, _weight(weight_col)).otherwise(F.lit(0)))
        return F.coalesce(hits, F.lit(0)).cast("bigint").alias(name)

    return predictions.filter(F.col("label").isNotNull()).agg(
        cell(actual & predicted, "true_positive"),
        cell(~actual & ~predicted, "true_negative"),
        cell(~actual & predicted, "false_positive"),
        cell(actual & ~predicted, "false_negative"),
    )


def sector_prediction_summary(
    predictions: DataFrame, positive: str = NO, weight_col: str | None = None
) -> DataFrame:
    """(sector, test_size, actual_left, predict_left).

    The size counts all rows of the sector; the "left" columns count the
    labelled rows whose actual or predicted class is ``positive``.
    """
    weight = _weight(weight_col)
    labelled = F.col("label").isNotNull()

    def left(column: str, name: str) -> Column:
        hit = labelled & (F.col(column) == positive)
        return F.sum(F.when(hit, weight).otherwise(F.lit(0))).cast("bigint").alias(name)

    return (
        require_sector(predictions)
        .groupBy("sector")
        .agg(
            F.sum(weight).cast("bigint").alias("test_size"),
            left("label", "actual_left"),
            left("predicted", "predict_left"),
        )
    )
