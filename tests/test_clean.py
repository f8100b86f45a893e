import pytest
from pyspark.sql import functions as F

from fraudlens.functions.scalars import entity_key, path_segment, relative_path, simplify_device, zero_default
from fraudlens.functions.vectors import padded
from fraudlens.operators import clean as c
from fraudlens.operators.encode import LabelEncoder, Scaler
from fraudlens.operators.profile import class_weights, column_medians, distinct_profile, pos_weight
from fraudlens.schema import FeatureSpec, cols_by_dtype, family_counts, identity_schema, infer_roles, transaction_schema


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_placeholders_are_exact(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["unknown", "Unknown", "UNKN", "UNKNOWN", "unknown "])], "i int, v string")
    assert [r.v for r in c.null_placeholders(df).orderBy("i").collect()] == [None, None, None, "UNKNOWN", "unknown "]


@pytest.mark.parametrize("values,median", [([1.0, 2.0, None, 10.0], 2.0), ([1.0, 2.0, 3.0, 10.0], 2.5), ([None, None], None)])
@pytest.mark.parametrize("cells", [0, 10**6])
def test_median(spark, values, median, cells):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert column_medians(df, ["x"], sample_cells=cells) == {"x": median}


@pytest.mark.parametrize("n", [1, 2, 7, 100, 3001])
def test_median_by_selection_equals_builtin(spark, n):
    # a third of the rows share one value, some are missing, negatives occur
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.hash("id") % 1000) / 7.0).alias("a"),
        F.when(F.col("id") % 5 != 0, (F.hash(F.col("id") + 1) % 50).cast("double")).alias("b"),
        F.lit(float("nan")).alias("c"),
    )
    built_in = df.agg(*[F.median(F.when(~F.isnan(c), F.col(c))).alias(c) for c in "abc"]).first().asDict()
    assert column_medians(df, ["a", "b", "c"]) == built_in
    assert column_medians(df, ["a", "b", "c"], sample_cells=0) == built_in
    assert built_in["c"] is None


def test_median_of_sparse_columns_is_bracketed(spark):
    """A column with few values gets a bracket of its own width, so few of its values are ordered."""
    from fraudlens.operators import profile

    df = spark.range(40_000).select(*[F.when(F.hash("id", F.lit(k)) % 50 == 0, F.rand(k)).alias(f"c{k}") for k in range(6)]).cache()
    num = {c: F.col(c) for c in df.columns}
    sizes = df.agg(*[F.count(c).alias(c) for c in df.columns]).first().asDict()
    bounds = profile._sampled_brackets(df, num, sizes, 0.5)
    below, upto = profile._rank_counts(df, num, bounds)
    missed = [c for c in df.columns if not below[c] <= (sizes[c] - 1) // 2 <= sizes[c] // 2 < upto[c]]
    assert len(missed) <= 1 and all(upto[c] - below[c] < sizes[c] * 0.7 for c in df.columns)


def test_imputer_fits_train_only(spark):
    df = spark.createDataFrame([("train", 1.0), ("train", 3.0), ("test", 100.0), ("test", None)], "split string, x double")
    assert c.MedianImputer(["x"], "train").fit(df).medians == {"x": 2.0}
    assert c.MedianImputer(["x"], "all").fit(df).medians == {"x": 3.0}
    filled = c.MedianImputer(["x"], "train").fit(df).transform(df)
    assert sorted(r.x for r in filled.collect()) == [1.0, 2.0, 3.0, 100.0]


def test_encode_as_text(spark):
    df = spark.createDataFrame([(0, 10), (1, 2), (2, None), (3, 2)], "i int, v int")
    out = LabelEncoder(["v"], missing="missing").fit(df).transform(df)
    assert [r.v for r in out.orderBy("i").collect()] == [0, 1, 2, 1]


@pytest.mark.parametrize(
    "classes,reserve,code",
    [(["a", "unknown"], False, 1), (["a", "b"], False, 0), (["a", "b"], True, 0), (["a", "z"], False, 1)],
)
def test_encode_unseen(spark, classes, reserve, code):
    train = spark.createDataFrame([(v,) for v in classes], "v string")
    out = LabelEncoder(["v"], reserve_unseen=reserve).fit(train).transform(spark.createDataFrame([("z",)], "v string"))
    assert out.first().v == code


def test_encode_large_dictionary_equals_inline(spark, monkeypatch):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 83).cast("string").alias("v"), (F.col("id") % 5).alias("w"))
    inline = df.join(LabelEncoder(["v", "w"]).fit(df).transform(df, "_code"), ["id", "v", "w"])
    values = sorted({str(i) for i in range(83)})
    for r in inline.collect():
        assert r.v_code == values.index(r.v) and r.w_code == r.w
    monkeypatch.setattr("fraudlens.operators.encode.INLINE", 0)
    joined = LabelEncoder(["v", "w"]).fit(df).transform(df)
    assert {(r.id, r.v, r.w) for r in joined.collect()} == {(r.id, r.v_code, r.w_code) for r in inline.collect()}


def test_scaler(spark):
    df = spark.createDataFrame([(float(i), 7.0) for i in (1, 2, 3, 4)], "x double, k double")
    fit = Scaler(["x", "k"], "all").fit(df)
    assert fit.mean["x"] == 2.5 and round(fit.std["x"], 6) == 1.118034
    out = fit.transform(df).orderBy("x").collect()
    assert [round(r.x, 6) for r in out] == [-1.341641, -0.447214, 0.447214, 1.341641]
    assert {r.k for r in out} == {0.0}


def test_roles(spark):
    df = spark.range(60).select(
        (F.col("id") % 2).alias("two"), (F.col("id") % 25).alias("many"), F.concat(F.lit("s"), (F.col("id") % 30)).alias("text"),
        (F.col("id") % 19).alias("nineteen"), (F.col("id") % 20).alias("twenty"), F.lit(None).cast("double").alias("empty"),
        (F.col("id") % 2).alias("isFraud"),
    )
    assert infer_roles(df, exclude=["isFraud"]) == {
        "two": "categorical", "many": "numerical", "text": "categorical", "nineteen": "categorical", "twenty": "numerical", "empty": "categorical",
    }
    spec = FeatureSpec.infer(df)
    assert "isFraud" not in spec.features and spec.columns()[-1] == "isFraud"


def test_distinct_profile_signs_and_nan(spark):
    df = spark.createDataFrame([(0.0, "a"), (-0.0, None), (float("nan"), "a"), (1.5, "b")], "x double, s string")
    assert {r.column: r.n_distinct for r in distinct_profile(df).collect()} == {"x": 2, "s": 2}


def test_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert {r.y: round(r.class_weight, 6) for r in class_weights(df, "y").collect()} == {0: 0.666667, 1: 2.0}
    assert pos_weight(df, "y").first().scale_pos_weight == 3.0
    assert pos_weight(df.filter("y = 0").limit(2), "y").first().scale_pos_weight == 2.0


def test_scalars(spark):
    df = spark.createDataFrame([("SAMSUNG SM-G892A Build/NRD90M", None, float("nan"))], "d string, n string, x double")
    row = df.select(
        simplify_device(F.col("d")).alias("device"), entity_key("card", F.col("d"), F.col("n")).alias("key"), zero_default(F.col("x")).alias("zero"),
        path_segment(F.lit("a/b/c"), 1).alias("part"), path_segment(F.lit("a"), 3).alias("none"), relative_path(F.lit("/x/y/z"), "/x").alias("rel"),
        padded([F.lit(1), F.lit(2)], 1, 4).alias("pad"),
    ).first()
    assert row.device == "samsung sm-g892a build" and row.key.endswith("_unknown") and row.zero == 0.0
    assert (row.part, row.none, row.rel, row.pad) == ("b", None, "y/z", [0.0, 1.0, 2.0, 0.0])


def test_device_and_label(spark):
    df = spark.createDataFrame([("X/1", 1), (None, 0)], "DeviceInfo string, isFraud int")
    assert [r.DeviceInfo_simple for r in c.add_simple_device(df).collect()] == ["x", "unknown"]
    assert c.add_simple_device(df.drop("DeviceInfo")).first().DeviceInfo_simple == "unknown"
    assert "is_fraud" in c.normalize_label(df).columns
    with pytest.raises(ValueError):
        c.normalize_label(df.drop("isFraud"))
    assert c.ensure_column(df, "isFraud", 9).first().isFraud == 1


def test_declared_schemas(spark):
    tx, idn = transaction_schema(), identity_schema()
    assert (len(tx), len(idn)) == (394, 41)
    assert len({*tx.names, *idn.names}) == 434
    empty = spark.createDataFrame([], tx).join(spark.createDataFrame([], idn), "TransactionID", "left")
    spec = FeatureSpec.fixed(empty)
    assert len(spec.categorical) == 9 + 2 + 9 + 2 + 27 and len(spec.numerical) == 1 + 14 + 15 + 339 + 11
    assert family_counts(spec.features) == {"C": 14, "D": 15, "V": 339, "id": 38}
    assert cols_by_dtype(empty, "string")[0] == "ProductCD"


def test_wide_table_runs_through(spark):
    """The whole cleaning, filling and scaling of 434 columns in one plan."""
    tx = transaction_schema()
    df = spark.range(40).select(
        *[
            (F.when(F.col("id") % 7 != 0, F.col("id") % 30).cast(f.dataType) if f.name != "TransactionID" else F.col("id")).alias(f.name)
            for f in tx.fields
        ]
    )
    spec = FeatureSpec.fixed(df)
    filled = c.MedianImputer(spec.numerical, "all").fit(df).transform(c.fill_categorical(c.null_placeholders(df), spec.categorical))
    scaled = Scaler(spec.numerical, "all").fit(filled).transform(filled)
    stats = scaled.agg(F.avg("V339"), F.stddev_pop("V339")).first()
    assert abs(stats[0]) < 1e-9 and abs(stats[1] - 1) < 1e-9
