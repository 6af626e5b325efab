"""One query per operator, over profiles derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerloom import functions as cf
from careerloom import operators as op
from careerloom import sources
from careerloom.plans import evaluate_held_out_year, headcount_report, jobs, tables
from careerloom.plans.tables import END_YEAR, START_YEAR, TEST_YEAR
from careerloom.schema import TOP_K

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

YEARS = (START_YEAR, END_YEAR)
TAGS = op.tag_columns(TOP_K)


class Inputs:
    """What queries read, derived from one folder of tables; each part is built once per query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.folder, name)

    @cached_property
    def profiles(self) -> DataFrame:
        return tables.profiles(self.spark, self.folder)

    @cached_property
    def profile_table(self) -> DataFrame:
        """The profiles as a written table, for queries that read them more than once."""
        return sources.written_table(self.profiles)

    @cached_property
    def sector_lookup(self) -> DataFrame:
        return sources.lookup_pairs(tables.sector_lines(self.spark, self.folder), "industry", "sector")

    @cached_property
    def places(self) -> DataFrame:
        return sources.place_lookup(tables.place_lines(self.spark, self.folder))

    def tag_lists(self, profiles: DataFrame) -> DataFrame:
        return op.tag_industries(op.distinct_skill_tags(profiles, ["batch"]), ["batch"])

    def tag_counts(self, profiles: DataFrame) -> DataFrame:
        rows = op.tag_row_sectors(self.tag_lists(profiles), self.sector_lookup, ["batch"])
        return op.tag_sector_counts(rows)

    @cached_property
    def learning_table(self) -> DataFrame:
        """The part of the profiles that sectors and learning need, as a written table."""
        dated = tables.profiles(self.spark, self.folder, ["start_date", "end_date"])
        return sources.written_table(jobs.learning_profiles(dated, keep=["batch"]))

    @cached_property
    def tag_tables(self) -> tuple[DataFrame, DataFrame]:
        return jobs.tag_tables(self.learning_table, self.sector_lookup)

    @cached_property
    def assigned(self) -> DataFrame:
        return op.assign_sector(self.learning_table, self.sector_lookup, self.tag_tables[0])

    @cached_property
    def headcount_people(self) -> DataFrame:
        """Pruned profiles with what headcounts need; the text of positions is not read."""
        dated = tables.profiles(self.spark, self.folder, ["start_date", "end_date"])
        narrow = sources.written_table(jobs.headcount_profiles(dated, keep=["batch"]))
        tag_sector, _ = jobs.tag_tables(narrow, self.sector_lookup)
        assigned = op.assign_sector(narrow, self.sector_lookup, tag_sector)
        return assigned.withColumn("industry", F.col("sector"))

    @cached_property
    def pruned(self) -> DataFrame:
        profiles = self.profile_table
        tag_sector, _ = jobs.tag_tables(profiles, self.sector_lookup)
        return op.prune_profile(op.assign_sector(profiles, self.sector_lookup, tag_sector))

    @cached_property
    def features(self) -> DataFrame:
        _, top_tags = self.tag_tables
        # Feature columns depend on the person only, so they come before the years unfold.
        people = op.feature_columns(op.require_sector(self.assigned), top_tags)
        return op.feature_rows(op.profile_year_panel(people, *YEARS, position_fields=()), top_tags)

    @cached_property
    def models(self) -> DataFrame:
        train, _ = op.split_by_year(self.features, TEST_YEAR)
        return op.train_sector_year_nb(train)

    @cached_property
    def test_rows_and_models(self) -> tuple[DataFrame, DataFrame]:
        train, test = op.split_by_year(sources.written_table(self.features), TEST_YEAR)
        return test, sources.written_table(op.sector_models(op.train_sector_year_nb(train)))

    @cached_property
    def predictions(self) -> DataFrame:
        return op.vote(*self.test_rows_and_models)


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query under its function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Inputs(spark, folder))

    QUERIES[fn.__name__] = run
    return fn


def big(name: str, alias: str | None = None):
    return F.col(name).cast("bigint").alias(alias or name)


def joined(name: str, separator: str = "|"):
    return F.concat_ws(separator, F.col(name)).alias(name)


def model_columns(models: DataFrame) -> DataFrame:
    return models.select(
        "sector",
        big("model_year"),
        "label",
        "n_rows",
        *[
            F.round(c, 4).alias(c)
            for c in ("mean_connections", "sd_connections", "mean_experience", "sd_experience")
        ],
        joined("tag_counts"),
    )


# Sources and sinks


def profile_array_columns(people: DataFrame) -> DataFrame:
    return people.select(
        "line_no",
        "first_name",
        "last_name",
        "industry",
        "location",
        "num_connections",
        joined("skills"),
        F.concat_ws("|", F.col("positions")["start_date"]).alias("start_dates"),
        F.concat_ws("|", F.col("positions")["company_name"]).alias("companies"),
        F.size(F.filter("positions", lambda p: p["is_current"])).cast("bigint").alias("n_current"),
    )


@query
def read_profile_arrays(x: Inputs) -> DataFrame:
    return profile_array_columns(sources.read_profile_arrays(tables.array_lines(x.profiles)))


@query
def read_profile_arrays_strict(x: Inputs) -> DataFrame:
    lines = tables.strict_lines(tables.array_lines(x.profiles))
    return profile_array_columns(sources.read_profile_arrays(lines, strict=True))


@query
def rejected_lines_strict(x: Inputs) -> DataFrame:
    rejected = sources.rejected_lines(tables.strict_lines(tables.array_lines(x.profiles)), strict=True)
    return rejected.groupBy("reason").agg(F.count("*").alias("n_lines"))


@query
def parse_lines(x: Inputs) -> DataFrame:
    """Profiles and rejects of one parse, and what was observed while they were written."""
    parsed = sources.parse_lines(tables.array_lines(x.profiles), columns=["industry"])
    counted, seen = sources.observed(
        parsed, n_profiles=F.count_if(F.col("reason").isNull()), n_rejects=F.count("reason")
    )
    table = sources.written_table(counted)
    found = sources.observed_row(x.spark, seen, "n_profiles bigint, n_rejects bigint")
    read = table.groupBy(F.coalesce("reason", F.lit("profile")).alias("kind")).agg(
        F.count("*").alias("n"), F.count("rejected_line").alias("n_lines"), F.count("industry").alias("n_industries")
    )
    observed = found.selectExpr("stack(2, 'observed profiles', n_profiles, 'observed rejects', n_rejects) AS (kind, n)")
    return read.unionByName(observed, allowMissingColumns=True)


@query
def read_profile_objects(x: Inputs) -> DataFrame:
    people = sources.read_profile_objects(
        tables.object_lines(x.profiles), columns=["first_name", "industry", "skills", "positions"]
    )
    return people.select(
        "pid",
        "first_name",
        "industry",
        joined("skills"),
        F.concat_ws("|", F.col("positions")["end_date"]).alias("end_dates"),
        F.contains("value", F.col("first_name")).cast("bigint").alias("raw_line_kept"),
    )


@query
def rejected_lines(x: Inputs) -> DataFrame:
    arrays = sources.rejected_lines(tables.array_lines(x.profiles)).withColumn("layout", F.lit("array"))
    objects = sources.rejected_lines(tables.object_lines(x.profiles), layout="object")
    both = arrays.unionByName(objects.withColumn("layout", F.lit("object")))
    return both.groupBy("layout", "reason").agg(F.count("*").alias("n_lines"))


@query
def lookup_pairs(x: Inputs) -> DataFrame:
    return sources.lookup_pairs(tables.customer_pair_lines(x.table("customer")))


@query
def lookup_lists(x: Inputs) -> DataFrame:
    lines = sources.key_list_lines(x.tag_lists(x.profiles), "tag", "industries", ["batch"])
    lists = sources.lookup_lists(lines, line_col="value", line_no_col="batch")
    return lists.select("key", joined("values"))


@query
def place_lookup(x: Inputs) -> DataFrame:
    return sources.place_lookup(tables.customer_place_lines(x.table("customer")))


@query
def read_matching_files(x: Inputs) -> DataFrame:
    orders = sources.read_matching_files(x.spark, x.folder, "order", "parquet")
    return orders.groupBy("o_orderstatus").agg(F.count("*").alias("n_orders"))


@query
def write_key_list(x: Inputs) -> DataFrame:
    path = f"{sources.scratch_folder(x.spark)}/tagindustry"
    tags = op.distinct_skill_tags(x.profiles)
    sources.write_key_list(op.tag_industries(tags), path, "tag", "industries")
    return x.spark.read.text(path)


@query
def write_named_outputs(x: Inputs) -> DataFrame:
    folder = sources.scratch_folder(x.spark)
    counts = sources.written_table(x.tag_counts(x.profiles), folder)
    best = op.top_sector_per_tag(counts).select(F.concat_ws(",", "tag", "sector").alias("value"))
    top = sources.key_list_lines(op.top_tags_per_sector(counts), "sector", "tags")
    sources.write_named_outputs({"tagsector": best, "toptags": top}, folder)
    outputs = [
        x.spark.read.text(f"{folder}/{name}").select(F.lit(name).alias("output"), "value")
        for name in ("tagsector", "toptags")
    ]
    return outputs[0].unionByName(outputs[1])


@query
def write_profile_json(x: Inputs) -> DataFrame:
    path = f"{sources.scratch_folder(x.spark)}/pruneddata"
    sources.write_profile_json(x.pruned, path)
    people = sources.read_profile_objects(x.spark.read.text(path))
    return people.select(
        "first_name",
        "industry",
        "num_connections",
        F.size("skills").cast("bigint").alias("n_skills"),
        F.concat_ws("|", F.col("positions")["start_date"]).alias("start_dates"),
        F.size(F.filter("positions", lambda p: p["summary"].isNotNull())).cast("bigint").alias("n_summaries"),
    )


def _stored_models(x: Inputs) -> DataFrame:
    path = f"{sources.scratch_folder(x.spark)}/models"
    sources.model_store(x.models, path)
    return path


@query
def model_store(x: Inputs) -> DataFrame:
    return model_columns(sources.model_load(x.spark, _stored_models(x)))


@query
def model_load(x: Inputs) -> DataFrame:
    wanted = ["AUTOMOTIVE", "TECHNOLOGY"]
    return model_columns(sources.model_load(x.spark, _stored_models(x), wanted))


def _year_store(x: Inputs) -> DataFrame:
    path = f"{sources.scratch_folder(x.spark)}/years"
    rows = op.year_store_rows(x.pruned, start_year=START_YEAR, end_year=END_YEAR)
    sources.year_store_write(rows, path)
    return sources.year_store_read(x.spark, path)


@query
def year_store_write(x: Inputs) -> DataFrame:
    return _year_store(x).groupBy(big("year"), "sector").agg(F.count("*").alias("n_rows"))


@query
def year_store_keys(x: Inputs) -> DataFrame:
    rows = sources.year_store_keys(_year_store(x), TEST_YEAR, "TECHNOLOGY")
    return rows.select(big("year"), "sector", "pid", "first_name", "last_title", "location")


@query
def year_store_scan(x: Inputs) -> DataFrame:
    people = sources.year_store_scan(_year_store(x), TEST_YEAR)
    position = F.col("positions")[0]
    return people.select(
        "pid",
        "first_name",
        "last_name",
        "num_connections",
        "industry",
        "location",
        position["title"].alias("title"),
        position["company_name"].alias("company_name"),
        position["start_date"].alias("start_date"),
    )


# Projections and filters


def _skills(x: Inputs) -> DataFrame:
    return x.profiles.select("pid", "industry", F.posexplode("skills").alias("pos", "skill"))


def _positions(profiles: DataFrame) -> DataFrame:
    return profiles.select("pid", F.posexplode("positions").alias("pos", "position"))


@query
def clean_tag(x: Inputs) -> DataFrame:
    return _skills(x).select(
        "pid",
        big("pos"),
        cf.clean_tag(F.col("skill")).alias("tag"),
        cf.clean_tag(F.col("industry")).alias("industry"),
    )


@query
def drop_blank(x: Inputs) -> DataFrame:
    rows = _skills(x).withColumn("tag", cf.clean_tag(F.col("skill")))
    return op.drop_blank(rows, "industry", "skill", "tag").select("pid", big("pos"), "industry", "skill")


@query
def explode_skill_tags(x: Inputs) -> DataFrame:
    return op.explode_skill_tags(x.profiles, ["pid"])


@query
def explode_title_tags(x: Inputs) -> DataFrame:
    return op.explode_title_tags(x.profiles, ["pid"])


@query
def clean_connections(x: Inputs) -> DataFrame:
    text = F.col("num_connections")
    return x.profiles.select(
        "pid",
        cf.clean_connections(text).alias("num_connections"),
        cf.connection_count(text).cast("bigint").alias("connections"),
    )


@query
def normalize_dates(x: Inputs) -> DataFrame:
    position = F.col("position")
    clean = x.profiles.withColumn("positions", cf.normalize_positions(F.col("positions")))
    return _positions(clean).select(
        "pid", big("pos"), position["start_date"].alias("start_date"), position["end_date"].alias("end_date")
    )


@query
def date_year(x: Inputs) -> DataFrame:
    position = F.col("position")
    return _positions(x.profiles).select(
        "pid",
        big("pos"),
        cf.date_year(position["start_date"]).cast("bigint").alias("from_year"),
        cf.date_year(position["end_date"]).cast("bigint").alias("to_year"),
    )


def _intervals(positions, interval):
    span = interval(F.col("position"), *YEARS)
    rows = positions.select("pid", big("pos"), *[span[c].cast("bigint").alias(c) for c in ("from_year", "to_year")])
    return rows.filter("from_year IS NOT NULL AND to_year IS NOT NULL")


@query
def position_interval(x: Inputs) -> DataFrame:
    return _intervals(_positions(x.profiles), cf.position_interval)


@query
def position_interval_current(x: Inputs) -> DataFrame:
    return _intervals(_positions(x.profiles), cf.position_interval_current)


@query
def prune_profile(x: Inputs) -> DataFrame:
    rows = x.pruned.select(
        "pid", "industry", "num_connections", F.posexplode_outer("positions").alias("pos", "position")
    )
    position = F.col("position")
    return rows.select(
        "pid",
        "industry",
        "num_connections",
        big("pos"),
        *[position[c].alias(c) for c in ("summary", "start_date", "end_date", "company_name")],
    )


@query
def require_sector(x: Inputs) -> DataFrame:
    return op.require_sector(x.assigned).select("pid", "sector")


@query
def valid_sector(x: Inputs) -> DataFrame:
    named = x.assigned.withColumn("sector", F.coalesce("sector", "industry"))
    return op.valid_sector(named).select("pid", "sector")


@query
def active_in_year(x: Inputs) -> DataFrame:
    return op.active_in_year(x.profiles, TEST_YEAR, *YEARS).select("pid")


@query
def location_tokens(x: Inputs) -> DataFrame:
    return op.location_tokens(x.profiles).select("pid", big("pos"), "token")


@query
def parse_tag_line(x: Inputs) -> DataFrame:
    lines = sources.key_list_lines(x.tag_lists(x.profiles), "tag", "industries", ["batch"])
    parsed = sources.parse_tag_line(lines, "value")
    return parsed.select(big("batch"), "tag", joined("industries"))


# Joins


@query
def industry_sector_join(x: Inputs) -> DataFrame:
    rows = x.profiles.select("pid", "industry")
    return op.industry_sector_join(rows, x.sector_lookup).select("pid", "industry", "sector")


@query
def assign_sector(x: Inputs) -> DataFrame:
    return x.assigned.select("pid", "sector")


@query
def skill_sector_join(x: Inputs) -> DataFrame:
    rows = op.skill_sector_join(x.learning_table, x.tag_tables[0])
    return rows.select("pid", big("pos"), "skill", "sector")


@query
def resolve_country(x: Inputs) -> DataFrame:
    return op.resolve_country(x.profiles, x.places)


@query
def attach_top_tags(x: Inputs) -> DataFrame:
    return op.attach_top_tags(x.assigned, x.tag_tables[1]).select("pid", "sector", joined("tags"))


@query
def score_join(x: Inputs) -> DataFrame:
    rows = op.score_join(*x.test_rows_and_models)
    pairs = rows.select("pid", "sector", F.explode_outer("models.model_year").alias("model_year"))
    return pairs.withColumn("model_year", big("model_year"))


# Unfolding by year


@query
def position_years(x: Inputs) -> DataFrame:
    return op.position_years(x.profiles, ["pid"], *YEARS).select(
        "pid", big("position_no"), big("year")
    )


@query
def profile_year_panel(x: Inputs) -> DataFrame:
    panel = op.profile_year_panel(x.profiles, *YEARS)
    return panel.select(
        "pid",
        big("year"),
        big("relevant_experience"),
        F.size("positions").cast("bigint").alias("n_positions"),
        F.concat_ws("|", F.col("positions")["title"]).alias("titles"),
    )


@query
def last_known_position(x: Inputs) -> DataFrame:
    rows = op.last_known_position(x.profiles, ["pid"], *YEARS)
    return rows.withColumn("year", big("year"))


@query
def year_store_rows(x: Inputs) -> DataFrame:
    rows = op.year_store_rows(x.pruned, start_year=START_YEAR, end_year=END_YEAR)
    return rows.withColumn("year", big("year")).withColumn("rel_experience", big("rel_experience"))


# Aggregations


@query
def tag_industries(x: Inputs) -> DataFrame:
    tags = op.distinct_skill_tags(x.profiles)
    return op.tag_industries(tags).select("tag", joined("industries"))


@query
def tag_row_sectors(x: Inputs) -> DataFrame:
    rows = op.tag_row_sectors(x.tag_lists(x.profiles), x.sector_lookup, ["batch"])
    return rows.withColumn("batch", big("batch"))


@query
def top_sector_per_tag(x: Inputs) -> DataFrame:
    return op.top_sector_per_tag(x.tag_counts(x.profiles))


@query
def top_tags_per_sector(x: Inputs) -> DataFrame:
    return op.top_tags_per_sector(x.tag_counts(x.profiles)).select("sector", joined("tags"))


@query
def dominant_skill_sector(x: Inputs) -> DataFrame:
    return op.dominant_skill_sector(x.learning_table, x.tag_tables[0])


@query
def position_year_counts(x: Inputs) -> DataFrame:
    counts = op.position_year_counts(x.profiles, *YEARS)
    return counts.withColumn("year", big("year"))


@query
def sector_country_active(x: Inputs) -> DataFrame:
    return headcount_report(x.headcount_people, x.places, TEST_YEAR, *YEARS)


@query
def sector_country_span(x: Inputs) -> DataFrame:
    return op.sector_country_span(_year_store(x), x.places, TEST_YEAR)


@query
def token_frequency(x: Inputs) -> DataFrame:
    return op.token_frequency(x.table("documents"), "text")


@query
def line_count(x: Inputs) -> DataFrame:
    return op.line_count(op.text_lines(x.table("documents"), "text"))


@query
def null_sector_count(x: Inputs) -> DataFrame:
    return op.null_sector_count(x.assigned, "sector", *YEARS)


@query
def year_store_row_count(x: Inputs) -> DataFrame:
    return op.year_store_row_count(
        op.year_store_rows(x.profiles, start_year=START_YEAR, end_year=END_YEAR)
    )


@query
def sector_year_order(x: Inputs) -> DataFrame:
    panel = op.profile_year_panel(x.assigned.select("pid", "sector", "positions"), *YEARS, position_fields=())
    # Ordering by ranges reads its input more than once.
    narrow = sources.written_table(panel.select("pid", "sector", "year"))
    ordered = op.sector_year_order(narrow)
    return ordered.select("pid", "sector", big("year"), big("group_no"))


# Learning and scoring


@query
def label_multi_position(x: Inputs) -> DataFrame:
    panel = op.profile_year_panel(x.profiles, *YEARS, position_fields=())
    return op.label_multi_position(panel).select("pid", big("year"), "label")


@query
def feature_rows(x: Inputs) -> DataFrame:
    rows = x.features
    return rows.select(
        "pid", "sector", big("year"), big("connections"), big("experience"), *[big(t) for t in TAGS], "label"
    )


@query
def split_by_year(x: Inputs) -> DataFrame:
    panel = op.profile_year_panel(x.profiles, *YEARS, position_fields=())
    train, test = op.split_by_year(panel, TEST_YEAR)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", big("year")).agg(F.count("*").alias("n_rows"))


@query
def train_sector_year_nb(x: Inputs) -> DataFrame:
    return model_columns(x.models)


@query
def merge_models(x: Inputs) -> DataFrame:
    """A model store of one batch of people to which two further ones are added, compared with one training."""
    train, _ = op.split_by_year(sources.written_table(x.features), TEST_YEAR)
    path = f"{sources.scratch_folder(x.spark)}/models"
    sources.model_store(op.train_sector_year_nb(train.filter("pid % 3 = 0")), path)
    for part in (1, 2):
        batch = sources.written_table(op.train_sector_year_nb(train.filter(F.col("pid") % 3 == part)))
        sources.model_replace(op.merge_models(sources.model_load(x.spark, path), batch), path)
    return model_columns(sources.model_load(x.spark, path))


@query
def score_nb(x: Inputs) -> DataFrame:
    scored = op.score_nb(*x.test_rows_and_models)
    return scored.select("pid", big("model_year"), "predicted")


@query
def vote(x: Inputs) -> DataFrame:
    return x.predictions.select("pid", "sector", big("votes"), "predicted")


@query
def confusion_counts(x: Inputs) -> DataFrame:
    return op.confusion_counts(x.predictions)


@query
def sector_prediction_summary(x: Inputs) -> DataFrame:
    return op.sector_prediction_summary(x.predictions)


@query
def predict_pipeline(x: Inputs) -> DataFrame:
    return evaluate_held_out_year(
        x.learning_table,
        x.sector_lookup,
        start_year=START_YEAR,
        end_year=END_YEAR,
        test_year=TEST_YEAR,
    )
