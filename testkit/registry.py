"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.config import ID_COLUMN, TARGET_COLUMN, RunConfig
from promolens.operators import customers, metrics, orders, prepare, quality, scoring, segments
from promolens.operators import split
from promolens.plans import runs
from promolens.session import staging_path, tune
from promolens.sources import artifacts, sinks
from promolens.sources.tables import SourceTables
from promolens.sources.text import read_features_csv
from testkit import boost, checks
from testkit.fixed_model import fixed_model
from testkit.oracle import MIN_SHARE, SEED
from testkit.views import AS_OF, source_tables

CONFIG = RunConfig(country_min_share=MIN_SHARE, seed=SEED)
Query = Callable[[SparkSession, str], DataFrame]

# Per (application, data folder): the stored feature table, what was learned from it, and
# the model folder, so that queries on the same data share the upstream steps.
_stored: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, build: Callable[[], object]) -> object:
    key = (spark.conf.get("spark.app.id"), sf_dir, what)
    if key not in _stored:
        _stored[key] = build()
    return _stored[key]


def tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    return _once(spark, sf_dir, "tables", lambda: source_tables(tune(spark), sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "features", lambda: runs.build_features(tables(spark, sf_dir), AS_OF)
    )


def metadata(spark: SparkSession, sf_dir: str) -> prepare.PrepMetadata:
    return _once(
        spark, sf_dir, "metadata", lambda: prepare.fit(features(spark, sf_dir), CONFIG)
    )


def model_dir(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        folder = staging_path(spark, "model")
        runs.fit_model(spark, features(spark, sf_dir), folder, CONFIG)
        return folder

    return _once(spark, sf_dir, "model", build)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with another engine."""
    return df.select(
        *(
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        )
    )


def _from_tables(step: Callable[[SourceTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(step(tables(spark, sf_dir)))


def _dated(step) -> Query:
    return _from_tables(lambda t: step(t, AS_OF))


def _from_features(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(features(spark, sf_dir))


def _scan_orders(t: SourceTables) -> DataFrame:
    return t.orders.withColumn("created_date", F.col("created_date").cast("date"))


def _scan_interactions(t: SourceTables) -> DataFrame:
    return t.interactions.withColumn("event_time", F.col("event_time").cast("string"))


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "feature-table")
    sinks.write_feature_table(customers.feature_table(tables(spark, sf_dir), AS_OF), path)
    return spark.read.parquet(path)


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "bucketed")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    sinks.save_feature_table(features(spark, sf_dir), table, buckets=8, path=path)
    return spark.table(table)


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "features-csv")
    sinks.write_csv(features(spark, sf_dir), path)
    return read_features_csv(spark, path)


def _dirty_dates(df: DataFrame) -> DataFrame:
    key = F.col(ID_COLUMN)
    return df.select(
        key,
        F.when(key % 7 == 0, "unknown")
        .when(key % 11 == 0, "2001-02-30")
        .when(key % 13 == 0, None)
        .otherwise(F.col("first_order_date").cast("string"))
        .alias("first_order_date"),
        F.col("last_order_date").cast("string").alias("last_order_date"),
        F.when(key % 5 == 0, "30.06.2001")
        .otherwise(F.col("as_of_date").cast("string"))
        .alias("as_of_date"),
    )


def _local_dates(df: DataFrame) -> DataFrame:
    """Dates as a local export writes them: day first, month first, and a month by name."""
    key = F.col(ID_COLUMN)
    return df.select(
        key,
        F.when(key % 7 == 0, "unknown")
        .when(key % 11 == 0, "31.02.2001")
        .when(key % 13 == 0, None)
        .when(key % 17 == 0, F.col("first_order_date").cast("string"))
        .otherwise(F.date_format("first_order_date", "dd.MM.yyyy"))
        .alias("first_order_date"),
        F.when(key % 5 == 0, "30.06.2001")
        .when(key % 3 == 0, F.date_format("last_order_date", "M/d/yyyy H:mm"))
        .otherwise(F.date_format("last_order_date", "MM/dd/yyyy"))
        .alias("last_order_date"),
        F.date_format("as_of_date", "d MMM yyyy").alias("as_of_date"),
    )


def _inferred_dates_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "local-dates-csv")
    sinks.write_csv(_local_dates(features(spark, sf_dir)), path)
    return read_features_csv(spark, path, date_formats="infer")


def _impossible(df: DataFrame) -> DataFrame:
    return quality.impossible_dates(df.withColumn("as_of_date", F.lit("2000-12-31").cast("date")))


def _flags_to_name(df: DataFrame) -> DataFrame:
    """Fold the data-dependent flag columns into the name of the flag that is set."""
    flags = [c for c in df.columns if c.startswith("country_")]
    name = F.concat_ws("+", *(F.when(F.col(c) == 1, c) for c in flags))
    return df.select(*(c for c in df.columns if c not in flags), name.alias("country_flag"))


def _onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = metadata(spark, sf_dir)
    flags = prepare.flag_columns(meta)
    kept = features(spark, sf_dir).select(ID_COLUMN, "country")
    encoded = prepare.encode_country(kept, meta.major_countries, flags)
    return encoded.unpivot(ID_COLUMN, list(flags), "flag", "value")


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.training_frame(features(spark, sf_dir), metadata(spark, sf_dir))


def _prepared_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "prepared")
    sinks.write_prepared(_prepared(spark, sf_dir), path)
    return _flags_to_name(spark.read.parquet(path))


def _metadata_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark, "metadata")
    artifacts.save_metadata(spark, metadata(spark, sf_dir), folder)
    stored = artifacts.load_metadata(spark, folder)
    return prepare.metadata_rows(features(spark, sf_dir), stored)


def _dropped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = metadata(spark, sf_dir)
    flags = prepare.flag_columns(meta)
    numeric = [c for c in meta.feature_columns if c not in flags]
    filled = prepare.fill_windows(features(spark, sf_dir))
    return quality.incomplete_rows(filled, numeric)


def _split(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _prepared(spark, sf_dir).select(ID_COLUMN, TARGET_COLUMN)
        return split.stratified(rows, fraction=0.2, seed=SEED, mode=mode)

    return query


def _balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.balance(_split("exact")(spark, sf_dir))


def _roc_auc(df: DataFrame) -> DataFrame:
    rows = prepare.add_target(df)
    return metrics.roc_auc(rows, "items_qty_lifetime", TARGET_COLUMN)


def _proxy_segments(df: DataFrame) -> DataFrame:
    proxy = df.select(ID_COLUMN, F.col("share_of_items_discounted").alias("score"))
    return segments.bucketize(proxy)


def _segments_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "segments-csv")
    sinks.write_csv(_proxy_segments(features(spark, sf_dir)), path)
    types = [(ID_COLUMN, "bigint"), ("score", "double"), ("segment", "string")]
    return read_features_csv(spark, path, types=types)


def _scoring_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags_to_name(scoring.scoring_frame(features(spark, sf_dir), metadata(spark, sf_dir)))


def _align_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with one feature empty, one absent, one extra, and unseen countries."""
    unseen = F.when(F.col(ID_COLUMN) % 9 == 0, "ATLANTIS").otherwise(F.col("country"))
    batch = (
        features(spark, sf_dir)
        .withColumn("orders_15d", F.lit(None).cast("bigint"))
        .drop("aov_net_lifetime_eur")
        .withColumn("basket_colour", F.lit(1))
        .withColumn("country", unseen)
    )
    return _flags_to_name(scoring.scoring_frame(batch, metadata(spark, sf_dir)))


def _train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = artifacts.load_metrics(spark, model_dir(spark, sf_dir))
    record |= {f"param_{name}": value for name, value in record.pop("params").items()}
    names = sorted(record)
    return spark.createDataFrame(
        [tuple(float(record[n]) for n in names)], ", ".join(f"{n} double" for n in names)
    )


def _train_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the training record does not depend on the trees."""
    names = ("n_train", "n_val", "pos_rate_train", "pos_rate_val", "feature_count")
    return _train_metrics(spark, sf_dir).select(*names)


def _importance_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature once, flags of countries as one name, none without a gain but zero."""
    flag = F.col("feature").startswith("country_")
    return _importance(spark, sf_dir).select(
        F.when(flag, "country").otherwise(F.col("feature")).alias("feature"),
        ((F.col("importance_gain") > 0) == (F.col("importance_split") > 0)).alias("consistent"),
    )


def _score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select(
        ID_COLUMN, F.col("score").between(0, 1).alias("is_probability")
    )


def _fixed_model_dir(spark: SparkSession, sf_dir: str) -> str:
    """A stored ensemble whose thresholds the expected results know."""
    def build() -> str:
        folder = staging_path(spark, "fixed-model")
        meta = metadata(spark, sf_dir)
        artifacts.save_run(spark, fixed_model(spark, meta), meta, {}, folder)
        return folder

    return _once(spark, sf_dir, "fixed model", build)


def _fixed_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _fixed_model_dir(spark, sf_dir)
    model = artifacts.load_model(spark, folder)
    scores = scoring.score(features(spark, sf_dir), model, artifacts.load_metadata(spark, folder))
    return scores.select(ID_COLUMN, F.round("score", 9).alias("score"))


def _fixed_model_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.importance_of(spark, _fixed_model_dir(spark, sf_dir))
    flag = F.col("feature").startswith("country_")
    return found.withColumn("feature", F.when(flag, "country").otherwise(F.col("feature")))


def _score_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.preview(_fixed_model_scores(spark, sf_dir).orderBy(ID_COLUMN))


def _round_model_dir(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "round model",
        lambda: boost.round_model(_prepared(spark, sf_dir), metadata(spark, sf_dir)),
    )


def _boost_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.importance_of(spark, _round_model_dir(spark, sf_dir))
    return found.withColumn("importance_gain", F.round("importance_gain", 6))


def _boost_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved record of a run, held-out AUC and best round included."""
    record = artifacts.load_metrics(spark, _round_model_dir(spark, sf_dir))
    rounded = ("validation_auc", "pos_rate_train", "pos_rate_val")
    names = ("best_iteration", "n_train", "n_val", "feature_count", *rounded)
    return spark.createDataFrame(
        [tuple(round(float(record[n]), 9) for n in names)], ", ".join(f"{n} double" for n in names)
    )


def _segment_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _end_to_end_distribution(spark, sf_dir).agg(
        F.sum("row_count").alias("customers"), F.round(F.sum("share"), 9).alias("share")
    )


def _split_missing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per side when every third key is missing: none is lost."""
    rows = _prepared(spark, sf_dir).select(ID_COLUMN, TARGET_COLUMN, "orders_lifetime")
    key = F.when(F.col(ID_COLUMN) % 3 != 0, F.col(ID_COLUMN))
    split_rows = split.stratified(
        rows.withColumn(ID_COLUMN, key), fraction=0.2, seed=SEED, mode="approx"
    )
    return split_rows.agg(
        F.count(F.lit(1)).alias("all_rows"), F.count("is_validation").alias("placed_rows")
    )


def _make_target_nan(df: DataFrame) -> DataFrame:
    nan = F.lit(float("nan"))
    odd = df.withColumn(
        "share_of_orders_with_discount",
        F.when(F.col(ID_COLUMN) % 2 == 0, nan).otherwise(F.col("share_of_orders_with_discount")),
    ).withColumn("discount_abs_lifetime_eur", F.lit(None).cast("double"))
    return prepare.add_target(odd).select(ID_COLUMN, TARGET_COLUMN)


def _drop_all_nan(df: DataFrame) -> DataFrame:
    odd = df.withColumn("aov_net_lifetime_eur", F.lit(float("nan")))
    kept = prepare.drop_all_null(odd).columns
    return df.sparkSession.createDataFrame([(c,) for c in kept], "column_name string")


def _csv_text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "features-csv")
    named = F.concat(F.lit("C-"), F.col(ID_COLUMN))
    sinks.write_csv(features(spark, sf_dir).withColumn(ID_COLUMN, named), path)
    return read_features_csv(spark, path, key_type="string", multi_line=True)


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.importance_of(spark, model_dir(spark, sf_dir))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = model_dir(spark, sf_dir)
    meta = artifacts.load_metadata(spark, folder)
    return scoring.score(features(spark, sf_dir), artifacts.load_model(spark, folder), meta)


def _end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark, "full-run")
    result = runs.run(spark, features(spark, sf_dir), folder, CONFIG, f"{folder}/out")
    return result.segments


def _resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs in one folder (first, again, new thresholds): which steps each did anew."""
    folder, rows = staging_path(spark, "resumed-run"), features(spark, sf_dir)
    seen = []
    for attempt, cfg in enumerate((CONFIG, CONFIG, CONFIG.with_changes(t1=0.3, t2=0.6)), 1):
        _, steps = runs.run_resumable(spark, rows, folder, cfg)
        written = spark.read.option("header", True).csv(steps.published()["scores_bucketized"])
        customers_out = written.count()
        seen += [(attempt, s, s in steps.reused, customers_out) for s in steps.built + steps.reused]
    return spark.createDataFrame(seen, "attempt int, step string, reused boolean, customers long")


def _end_to_end_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = model_dir(spark, sf_dir)
    scored = runs.score_only(spark, features(spark, sf_dir), folder, CONFIG)
    return segments.distribution(scored)


def _boosted(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(boost.rows_of(_prepared(spark, sf_dir)))


def _boost_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = prepare.fill_zero(features(spark, sf_dir), boost.NUMERIC_FEATURES)
    return boost.expressions_agree(boost.rows_of(_prepared(spark, sf_dir)), zero)


CONSTANT_CANDIDATES = (
    "gender", "shops_included", "registration_flag", "account_age_days", "country",
)

QUERIES: dict[str, Query] = {
    "scan_orders": _from_tables(_scan_orders),
    "scan_orderitems": _from_tables(lambda t: t.order_items),
    "scan_refunds": _from_tables(lambda t: t.refunds),
    "scan_currencyrates": _from_tables(lambda t: t.currency_rates),
    "scan_interactions": _from_tables(_scan_interactions),
    "scan_customers": _from_tables(lambda t: t.customers),
    "params": _dated(orders.lookback_windows),
    "fx_rates_dup_check": _from_tables(orders.rate_duplicates),
    "orders_base": _dated(orders.orders_base),
    "orderitems_net": _dated(orders.priced_lines),
    "product_lines": _dated(orders.product_lines),
    "unit_price_order": _dated(orders.unit_price_per_number),
    "order_level": _dated(orders.order_level),
    "cif_order_map": _from_tables(orders.order_customer_map),
    "orders_mapped": _dated(orders.orders_mapped),
    "cust_shop": _dated(customers.customer_shop),
    "items_discount_share": _dated(customers.shop_item_share),
    "customer_rollup": _dated(customers.customer_rollup),
    "items_discount_share_cust": _dated(customers.customer_item_share),
    "cust_attrs": _from_tables(customers.customer_attributes),
    "feature_table": _dated(customers.feature_table),
    "feature_table_write": _written,
    "feature_table_bucketed": _bucketed,
    "csv_round_trip": _csv_round_trip,
    "table_profile": _from_features(quality.table_profile),
    "coerce_dates": _from_features(lambda df: prepare.coerce_dates(_dirty_dates(df))),
    "date_parse_failures": _from_features(lambda df: quality.date_parse_failures(_dirty_dates(df))),
    "coerce_dates_inferred": _from_features(
        lambda df: prepare.coerce_dates(_local_dates(df), formats="infer")
    ),
    "date_failures_inferred": _from_features(
        lambda df: quality.date_parse_failures(_local_dates(df), formats="infer")
    ),
    "inferred_dates_csv": _inferred_dates_csv,
    "date_summary": _from_features(quality.date_summary),
    "impossible_dates": _from_features(_impossible),
    "fill_report": _from_features(quality.fill_report),
    "drop_all_null": _from_features(prepare.drop_all_null),
    "fill_window_zero": _from_features(prepare.fill_windows),
    "make_target": _from_features(
        lambda df: prepare.add_target(df).select(ID_COLUMN, TARGET_COLUMN)
    ),
    "target_distribution": _from_features(
        lambda df: prepare.target_distribution(prepare.add_target(df))
    ),
    "country_share": _from_features(prepare.country_share),
    "country_onehot": _onehot,
    "constant_columns": _from_features(
        lambda df: quality.constant_columns(df, CONSTANT_CANDIDATES)
    ),
    "prepared": lambda spark, sf_dir: _flags_to_name(_prepared(spark, sf_dir)),
    "prepared_round_trip": _prepared_round_trip,
    "prep_metadata": _metadata_rows,
    "dropped_rows": _dropped_rows,
    "stratified_split": _split("exact"),
    "stratified_split_approx": _split("approx"),
    "split_balance": _balance,
    "train_metrics": _train_metrics,
    "train_counts": _train_counts,
    "feature_importance_names": _importance_names,
    "score_rows": _score_rows,
    "fixed_model_scores": _fixed_model_scores,
    "fixed_model_importance": _fixed_model_importance,
    "score_preview": _score_preview,
    "argument_checks": lambda spark, sf_dir: checks.argument_checks(
        features(spark, sf_dir), metadata(spark, sf_dir)
    ),
    "segment_totals": _segment_totals,
    "split_missing_key": _split_missing_key,
    "make_target_nan": _from_features(_make_target_nan),
    "drop_all_nan": _from_features(_drop_all_nan),
    "csv_text_key": _csv_text_key,
    "feature_importance": _importance,
    "roc_auc": _from_features(_roc_auc),
    "scoring_frame": _scoring_frame,
    "align_features": _align_features,
    "score_customers": _scores,
    "bucketize": _from_features(_proxy_segments),
    "segments_csv": _segments_csv,
    "segment_distribution": _from_features(
        lambda df: segments.distribution(_proxy_segments(df))
    ),
    "end_to_end_segments": _end_to_end,
    "resumed_run": _resumed_run,
    "end_to_end_distribution": _end_to_end_distribution,
    "boost_bins": _boosted(boost.bins),
    "boost_draws": _boosted(boost.draws),
    "boost_gradient_sums": _boosted(boost.gradient_sums),
    "boost_round": _boosted(boost.first_round),
    "boost_importance": _boost_importance,
    "boost_metrics": _boost_metrics,
    "boost_rounds": _boosted(boost.rounds),
    "boost_expressions": _boost_expressions,
}
