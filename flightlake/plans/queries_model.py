"""Queries of the encoder, model and registry operators."""

from __future__ import annotations

import functools

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake import schemas
from flightlake.functions import defaults, features, messages
from flightlake.operators import encode, model, registry, training
from flightlake.plans import views
from flightlake.plans.catalog import query
from flightlake.session import drop_unused_shuffles, materialize, scratch_dir

TRAINING_INPUT = [c for c in schemas.FEATURES if c != "Route"] + ["ArrDelay"]


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = materialize(training.training_set(views.flights(spark, sf, *TRAINING_INPUT)), "training")
    return training.split_by_key(rows, [*schemas.FEATURES, schemas.LABEL])


@functools.lru_cache(maxsize=4)
def fitted(spark: SparkSession, sf: str) -> tuple[model.DelayModel, DataFrame]:
    """(model, test rows), trained once per session and folder."""
    train, test = _parts(spark, sf)
    trained = model.train(train)
    # The rows as they were dealt for training.
    drop_unused_shuffles(spark, wait=3)
    return trained, test


@query(
    "ordinal_encode",
    """WITH known AS (SELECT "Route", CAST(row_number() OVER (ORDER BY "Route") - 1 AS INTEGER) AS code FROM
         (SELECT DISTINCT concat_ws('-', "Origin", "Dest") AS "Route" FROM flights WHERE "Distance" <= 700))
       SELECT f."FlightNum", f."Route", coalesce(k.code, -1) AS "Route_code" FROM
         (SELECT "FlightNum", concat_ws('-', "Origin", "Dest") AS "Route" FROM flights) f LEFT JOIN known k ON f."Route" = k."Route" """,
    "flights",
)
def _(spark, sf):
    rows = views.flights(spark, sf, "FlightNum", "Origin", "Dest", "Distance").withColumn(
        "Route", features.route_skip_nulls()
    )
    # Fitted on short flights only, so long routes are unknown.
    codes = encode.fit_codes(rows.filter("Distance <= 700"), ["Route"])
    return encode.apply_codes(rows.select("FlightNum", "Route"), codes, ["Route"])


@query(
    "string_index",
    """WITH f AS (SELECT "FlightNum", "Carrier", "Origin", "Dest", "Origin" || '-' || "Dest" AS "Route" FROM flights),
       c AS (SELECT "Carrier", row_number() OVER (ORDER BY "Carrier") - 1 AS i FROM (SELECT DISTINCT "Carrier" FROM f)),
       o AS (SELECT "Origin", row_number() OVER (ORDER BY "Origin") - 1 AS i FROM (SELECT DISTINCT "Origin" FROM f)),
       d AS (SELECT "Dest", row_number() OVER (ORDER BY "Dest") - 1 AS i FROM (SELECT DISTINCT "Dest" FROM f WHERE "Dest" IS NOT NULL)),
       r AS (SELECT "Route", row_number() OVER (ORDER BY "Route") - 1 AS i FROM (SELECT DISTINCT "Route" FROM f WHERE "Route" IS NOT NULL))
       SELECT f."FlightNum", CAST(c.i AS DOUBLE) AS "Carrier_index", CAST(o.i AS DOUBLE) AS "Origin_index",
         CAST(coalesce(d.i, (SELECT count(*) FROM d)) AS DOUBLE) AS "Dest_index",
         CAST(coalesce(r.i, (SELECT count(*) FROM r)) AS DOUBLE) AS "Route_index"
       FROM f LEFT JOIN c ON f."Carrier" = c."Carrier" LEFT JOIN o ON f."Origin" = o."Origin" LEFT JOIN d ON f."Dest" = d."Dest"
         LEFT JOIN r ON f."Route" = r."Route" """,
    "flights",
)
def _(spark, sf):
    rows = views.flights(spark, sf, "FlightNum", "Carrier", "Origin", "Dest").withColumn(
        "Route", features.route_or_null()
    )
    indexed = encode.index_columns(rows, encode.fit_codes(rows))
    return indexed.select("FlightNum", *[f"{c}_index" for c in schemas.CATEGORICAL])


@query(
    "assemble_features",
    """SELECT "FlightNum", "DepDelay" AS v0, "ArrDelay" AS v1, "Distance" AS v2, "ArrDelay" IS NULL AS v1_nan FROM flights""",
    "flights",
)
def _(spark, sf):
    inputs = ["DepDelay", "ArrDelay", "Distance"]
    rows = views.flights(spark, sf, "FlightNum", *inputs)
    vector = vector_to_array(F.col("Features_vec"))
    items = encode.assembler(inputs).transform(rows).select("FlightNum", vector.alias("v"))
    v1 = F.col("v")[1]
    return items.select(
        "FlightNum", F.col("v")[0].alias("v0"), F.when(~F.isnan(v1), v1).alias("v1"),
        F.col("v")[2].alias("v2"), F.isnan(v1).alias("v1_nan"),
    )


_CODED = ("Carrier", "Origin", "TailNum")


@query(
    "ordinal_encode_all",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", "{c}" AS "value", CAST(row_number() OVER (ORDER BY "{c}") - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT "{c}" FROM flights)""" for c in _CODED
    ),
    "flights",
)
def _(spark, sf):
    return encode.fit_codes(views.flights(spark, sf, *_CODED), list(_CODED))


@query("train_test_split", """SELECT "FlightNum", "TailNum", "FlightDate", true AS near_80_percent FROM flights""", "flights")
def _(spark, sf):
    """Which part a row falls in is random; together the parts are all rows, each once, and the first holds about 80 %."""
    rows = materialize(views.flights(spark, sf, "FlightNum", "TailNum", "FlightDate"), "flights")
    train, test = training.split_random(rows)
    share = train.count() / max(1, rows.count())
    return train.unionByName(test).withColumn("near_80_percent", F.lit(abs(share - 0.8) < 0.03))


@query(
    "train_test_split_key",
    """SELECT "FlightNum", "TailNum", "FlightDate",
       CASE WHEN CAST('0x' || substr(md5("FlightNum" || '|' || "TailNum" || '|' || "FlightDate"), 1, 8) AS BIGINT) < 0.8 * 4294967296
       THEN 'train' ELSE 'test' END AS part FROM flights""",
    "flights",
)
def _(spark, sf):
    rows = views.flights(spark, sf, "FlightNum", "TailNum", "FlightDate")
    train, test = training.split_by_key(rows, ["FlightNum", "TailNum", "FlightDate"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# The test rows: a hash of all columns in the last fifth.
_KEY = " || '|' || ".join(f'CAST("{c}" AS VARCHAR)' for c in [*schemas.FEATURES, schemas.LABEL])
_SHARE = f"""CAST('0x' || substr(md5({_KEY}), 1, 8) AS BIGINT)"""
_TEST_ROWS = f"""SELECT * FROM training WHERE {_SHARE} >= 0.8 * 4294967296"""


@query(
    "rf_train",
    f"""SELECT "ArrDelayBucket", CAST(count(*) AS BIGINT) AS n, 100 AS trees, 12 AS depth, 9 AS features, 1.0::DOUBLE AS importance
        FROM training WHERE {_SHARE} < 0.8 * 4294967296 GROUP BY "ArrDelayBucket" """,
    "training",
)
def _(spark, sf):
    """Trains here, not through the cache: training rows per class, and the forest that they made."""
    train, _test = _parts(spark, sf)
    forests = model.train(train).forests
    importance = sum(f.featureImportances.toArray() * f.getNumTrees for f in forests)
    grown = sum(f.getNumTrees for f in forests)
    allowed = max(f.getMaxDepth() for f in forests)
    deepest = max(tree.depth for f in forests for tree in f.trees)
    return train.groupBy(schemas.LABEL).agg(F.count(F.lit(1)).alias("n")).select(
        schemas.LABEL, "n", F.lit(grown).alias("trees"), F.lit(max(allowed, deepest)).alias("depth"),
        F.lit(max(f.numFeatures for f in forests)).alias("features"), F.lit(round(float(importance.sum() / grown), 9)).alias("importance"),
    )


@query("rf_score_batch", f"SELECT *, true AS scored FROM ({_TEST_ROWS})", "training")
def _(spark, sf):
    """Every test row is scored once, with a class; which one is the forest's."""
    fitted_model, test = fitted(spark, sf)
    scored = fitted_model.transform(test)
    return scored.withColumn("scored", F.col("Prediction").isin(0, 1, 2, 3)).drop("Prediction")


@query(
    "rf_accuracy",
    f"""SELECT CAST(sum(n) AS BIGINT) AS "rows", true AS beats_largest_class
        FROM (SELECT count(*) AS n FROM ({_TEST_ROWS}) GROUP BY "ArrDelayBucket")""",
    "training",
)
def _(spark, sf):
    """The forest must do better than always naming the largest class."""
    fitted_model, test = fitted(spark, sf)
    counts = model.confusion_counts(fitted_model.transform(test))
    right = F.sum(F.when(F.col("ArrDelayBucket") == F.col("Prediction"), F.col("n")).otherwise(0))
    classes = counts.groupBy("ArrDelayBucket").agg(F.sum("n").alias("n"), right.alias("right"))
    return classes.agg(
        F.sum("n").alias("rows"), (F.sum("right") > F.max("n")).alias("beats_largest_class")
    )


# Fixed predictions for the metric checks: class the departure delay instead.
def _guessed(spark, sf):
    rows = views.flights(spark, sf, "DepDelay", "ArrDelay")
    return rows.select(
        features.delay_class("ArrDelay").alias("ArrDelayBucket"),
        features.delay_class("DepDelay").alias("Prediction"),
    )


_GUESSED = """SELECT CASE WHEN "ArrDelay" < -15 THEN 0 WHEN "ArrDelay" < 0 THEN 1 WHEN "ArrDelay" < 30 THEN 2 ELSE 3 END AS "ArrDelayBucket",
  CASE WHEN "DepDelay" < -15 THEN 0 WHEN "DepDelay" < 0 THEN 1 WHEN "DepDelay" < 30 THEN 2 ELSE 3 END AS "Prediction" FROM flights"""


@query(
    "accuracy",
    f"""SELECT round(avg(CASE WHEN "ArrDelayBucket" = "Prediction" THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 9) AS accuracy FROM ({_GUESSED})""",
    "flights",
)
def _(spark, sf):
    return model.accuracy(_guessed(spark, sf)).select(F.round("accuracy", 9).alias("accuracy"))


@query(
    "confusion_counts",
    f"""SELECT "ArrDelayBucket", "Prediction", CAST(count(*) AS BIGINT) AS n FROM ({_GUESSED}) GROUP BY ALL""",
    "flights",
)
def _(spark, sf):
    return model.confusion_counts(_guessed(spark, sf))


@query(
    "model_save_load",
    f"""SELECT "ArrDelayBucket", CAST(count(*) AS BIGINT) AS n, true AS alike FROM ({_TEST_ROWS}) GROUP BY "ArrDelayBucket" """,
    "training",
)
def _(spark, sf):
    """Per class, the test rows and whether the reloaded model scores them as before."""
    fitted_model, test = fitted(spark, sf)
    path = scratch_dir(spark, "model")
    fitted_model.save(path)
    reloaded = model.DelayModel.load(spark, path)
    before = fitted_model.transform(test).withColumnRenamed("Prediction", "before")
    both = reloaded.transform(before)
    alike = F.bool_and(F.col("before") == F.col("Prediction")).alias("alike")
    return both.groupBy("ArrDelayBucket").agg(F.count(F.lit(1)).alias("n"), alike)


@query(
    "score_udf",
    """SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE "UUID" END AS "UUID", CASE WHEN event_id % 97 = 0 THEN 'AA' ELSE "Carrier" END AS "Carrier",
       CASE WHEN event_id % 97 = 0 THEN 'LAX' ELSE "Origin" END AS "Origin", CASE WHEN event_id % 97 = 0 THEN 'JFK' ELSE "Dest" END AS "Dest",
       true AS scored FROM requests""",
    "requests",
)
def _(spark, sf):
    """One integer class per request, on the stand-ins where fields are missing."""
    fitted_model, _test = fitted(spark, sf)
    parsed = messages.parse_messages(views.request_lines(spark, sf), schemas.REQUEST)
    scored = fitted_model.transform(defaults.fill_by_field(parsed))
    return scored.select(
        "UUID", "Carrier", "Origin", "Dest", F.col("Prediction").isin(0, 1, 2, 3).alias("scored")
    )


@query(
    "registry_log_run",
    """SELECT run_id, accuracy, '100' AS n_estimators, '12' AS max_depth, 9 AS n_features FROM runs""",
    "runs",
)
def _(spark, sf):
    logged = views.runs(spark, sf).select(
        "run_id",
        F.create_map(
            F.lit("n_estimators"), F.lit(str(model.TREES)), F.lit("max_depth"), F.lit(str(model.DEPTH))
        ).alias("params"),
        F.array(*[F.lit(f) for f in schemas.FEATURES]).alias("features"),
        "accuracy",
    )
    path = scratch_dir(spark, "runs")
    logged.write.mode("append").parquet(path)
    stored = spark.read.schema(schemas.RUN).parquet(path)
    return stored.select(
        "run_id", "accuracy", F.col("params")["n_estimators"].alias("n_estimators"),
        F.col("params")["max_depth"].alias("max_depth"), F.size("features").alias("n_features"),
    )


_PROMOTED = """SELECT v."name", v."version", CASE WHEN v."version" = c.chosen THEN 'Production'
  WHEN v.stage = 'Production' AND c.chosen IS NOT NULL THEN 'Archived' ELSE v.stage END AS stage, v.run_id
  FROM versions v LEFT JOIN (SELECT "name", max("version") AS chosen FROM versions WHERE stage IN ('None', 'Staging') GROUP BY "name") c
  ON v."name" = c."name" """


@query("registry_promote", _PROMOTED, "versions")
def _(spark, sf):
    return registry.promote(views.versions(spark, sf))


@query(
    "registry_production",
    """SELECT "name", max("version") AS "version", 'Production' AS stage, max_by(run_id, "version") AS run_id
       FROM versions WHERE stage = 'Production' GROUP BY "name" """,
    "versions",
)
def _(spark, sf):
    return registry.production(views.versions(spark, sf))


@query(
    "registry_runs_report",
    """SELECT substr(run_id, 1, 8) AS run, accuracy FROM (SELECT * FROM runs ORDER BY trained_at DESC, run_id LIMIT 5)""",
    "runs",
)
def _(spark, sf):
    return registry.runs_report(views.runs(spark, sf))


@query(
    "model_ref_latest",
    """SELECT model_name, model_path, trained_at, accuracy, run_id FROM runs WHERE model_name = 'model-1-URGENT'
       ORDER BY trained_at DESC, run_id DESC LIMIT 1""",
    "runs",
)
def _(spark, sf):
    refs = views.runs(spark, sf).select("model_name", "model_path", "trained_at", "accuracy", "run_id")
    return registry.latest_ref(refs, "model-1-URGENT")
