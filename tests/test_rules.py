"""Small fixtures with hand-computed results and error cases."""

import pytest
from pyspark.sql import functions as F

from lastmile.operators import clean, cluster, compare, features, labels, learners, prep, profile, score, search
from lastmile.plans import flows
from lastmile.sources import models, tables


def column(spark, values, name="target_tiempo_entrega", kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"split_key long, {name} {kind}")


def test_thresholds(spark):
    found = labels.fit_terciles(column(spark, [20.0, 28.0, 33.0, 41.0, 55.0, 70.0]))
    assert found == pytest.approx({"q33": 94 / 3, "q66": 137 / 3})


def test_labels_by_time(spark):
    df = column(spark, [20.0, 28.0, 33.0, 41.0, 55.0, 70.0])
    labelled, _ = labels.add_delivery_class(df)
    assert [r[2] for r in labelled.orderBy("split_key").collect()] == ["rapida"] * 2 + ["normal"] * 2 + ["tardia"] * 2
    assert df.columns == ["split_key", "target_tiempo_entrega"]


def test_apply_thresholds(spark):
    df = column(spark, [18.0, 30.0, 42.0, 60.0, None, 0.0])
    got = labels.apply_terciles(df, {"q33": 30, "q66": 45}).orderBy("split_key").collect()
    assert [r[2] for r in got] == ["rapida", "rapida", "normal", "tardia", "normal", "rapida"]


@pytest.mark.parametrize("values", [[], [None, -1.0], [5.0, 5.0, 6.0], [3.0] * 9 + [4.0, 5.0]])
def test_threshold_errors(spark, values):
    with pytest.raises(ValueError):
        labels.fit_terciles(column(spark, values))


def test_threshold_order_is_checked(spark):
    with pytest.raises(ValueError):
        labels.apply_terciles(column(spark, [1.0]), {"q33": 5, "q66": 5})
    with pytest.raises(ValueError):
        labels.apply_terciles(column(spark, [1.0]), {"q33": 5})


def test_split_before_labels(spark):
    rows = [
        (i, d, t, c, m)
        for i, (d, t, c, m) in enumerate(zip(
            [2, 4, 8, 12, 18, 25, 30, 35, 9, 14],
            ["Bajo", "Medio", "Alto", "Medio", "Alto", "Bajo", "Medio", "Alto", "Bajo", "Medio"],
            ["Soleado", "Nublado", "Lluvia", "Soleado", "Lluvia", "Nublado", "Soleado", "Lluvia", "Nublado", "Soleado"],
            range(20, 70, 5),
        ))
    ]
    df = spark.createDataFrame(rows, "split_key long, distancia_km int, trafico_nivel string, clima string, target_tiempo_entrega int")
    ready = prep.prepare_by_time(df)
    train, test = prep.parts(ready.rows)
    assert train.count() == 8 and test.count() == 2
    assert ready.thresholds["q33"] < ready.thresholds["q66"]
    assert ready.numbers == ["distancia_km"] and ready.categories == ["trafico_nivel", "clima"]


@pytest.mark.parametrize("text, value", [
    (" 12 ", 12.0), ("1,5", 1.5), ("1.234,5", None), ("1.0d", None), ("2f", None), ("NaN", None), ("", None),
    ("\t7\t", 7.0), ("-3e2", -300.0), ("inf", float("inf")), ("0x1p3", None), ("abc", None), ("1e", None),
])
def test_number_texts(spark, text, value):
    df = spark.createDataFrame([(text,)], "distancia_km string")
    assert clean.parse_numeric(df, ["distancia_km"]).first()[0] == value


def test_text_forms(spark):
    df = spark.createDataFrame([("\t Crítico \n",), ("Sin Dato",), ("N/A",), (None,)], "clima string")
    assert [r[0] for r in clean.clean_text(df, ["clima"]).collect()] == ["crítico", None, None, None]
    key = df.select(labels.text_key(F.col("clima"))).first()[0]
    assert key == "critico"


def test_rank_percent_ties(spark):
    ranked = labels.rank_percent(column(spark, [1.0, 2.0, 2.0, 3.0, None], "x"), {"x": "r"}).orderBy("split_key")
    assert [r["r"] for r in ranked.collect()] == [0.25, 0.625, 0.625, 1.0, None]


def test_mode_tie_takes_the_smallest(spark):
    df = column(spark, ["b", "a", "b", "a", None], "c", "string")
    assert prep.fit_impute(df, [], ["c"]) == {"c": "a"}


def test_ratios_of_zero_and_null(spark):
    df = spark.createDataFrame(
        [(0.0, 1.0, 1.0, 1.0, 1.0), (None, 1.0, 1.0, 1.0, 1.0), (2.0, 1.0, None, 4.0, 0.0)],
        "distancia_km double, costo_envio double, consumo_nafta double, peso_carga_kg double, paradas_previas double",
    )
    got = features.add_ratios(df).select(*features.RATIOS).collect()
    assert [tuple(r) for r in got] == [(None,) * 4, (None,) * 4, (0.5, None, 2.0, 0.0)]


def test_absent_inputs_give_zero_marks(spark):
    got = features.add_error_focused_features(column(spark, ["van"], "clima", "string")).first().asDict()
    assert all(got[c] == 0 for c in features.ERROR_FOCUSED)


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (3.0, 2.0, None)], "target_tiempo_entrega double, same double, none double")
    got = {r["columna"]: r["correlacion"] for r in profile.corr_with_target(df).collect()}
    assert got == {"same": None, "none": None}
    assert prep.fit_scale(df, ["same"])["same"] == (2.0, 1.0)
    reasons = dict(clean.exclude_columns(df.withColumn("c", F.lit("a")), "c"))
    assert reasons == {"target_tiempo_entrega": "posible_fuga_de_datos", "same": "columna_constante", "none": "columna_constante", "c": "columna_target"}


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError):
        clean.require_columns(column(spark, [1.0]), ["clima"])
    with pytest.raises(ValueError):
        features.add_cyclic_hour(column(spark, [1.0]))
    with pytest.raises(RuntimeError):
        prep.GroupMeans().transform(column(spark, [1.0]))


def test_unseen_category_gets_the_overall_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0)], "clima string, target_tiempo_entrega double")
    encoder = prep.GroupMeans(["clima"]).fit(df)
    got = encoder.transform(spark.createDataFrame([("a",), ("z",), (None,)], "clima string"))
    assert sorted(r[1] for r in got.collect()) == [2.0, 4.0, 4.0]


def scored(spark, rows):
    return spark.createDataFrame([("m", float(a), float(b)) for a, b in rows], "model string, real double, predicho double")


def test_scores_by_hand(spark):
    df = scored(spark, [(10, 12), (20, 14), (30, 41), (40, 40)])
    row = score.reg_metrics_full(df).first()
    assert row["MAE"] == 4.75 and row["RMSE"] == pytest.approx((161 / 4) ** 0.5)
    assert row["R2"] == pytest.approx(1 - 161 / 500)
    assert (row["acc_5_min"], row["acc_10_min"], row["acc_15_min"]) == (50.0, 75.0, 100.0)
    assert row["median_absolute_error"] == 4.0 and row["p90_absolute_error"] == pytest.approx(9.5)


def test_constant_target_and_empty_scores(spark):
    assert score.reg_metrics(scored(spark, [(5, 5), (5, 5)])).first()["R2"] == 1.0
    assert score.reg_metrics(scored(spark, [(5, 4), (5, 5)])).first()["R2"] == 0.0
    empty = score.tolerance_hits(scored(spark, [])).collect()
    assert [(r["hit_count"], r["accuracy_percent"]) for r in empty] == [(0, 0.0)] * 3


def test_segments_keep_nulls_and_fall_back(spark):
    df = scored(spark, [(10, 12), (20, 14), (30, 41)]).withColumn("clima", F.when(F.col("real") > 15, "x"))
    got = score.segment_metrics(score.error_direction(df), ["clima"])
    assert {r["segment_value"]: r["n"] for r in got.collect()} == {None: 1, "x": 2}
    assert [r["segment_label"] for r in score.segment_labels(got).collect()] == ["clima=x", "clima=nan"]
    assert score.segment_metrics(score.error_direction(df), ["absent"]).count() == 0


def test_zero_division_scores(spark):
    df = spark.createDataFrame([("m", "a", "a"), ("m", "b", "a"), ("m", "b", "c")], "model string, real string, predicho string")
    row = score.cls_metrics(df).first()
    assert row["accuracy"] == pytest.approx(1 / 3)
    assert row["f1_macro"] == pytest.approx((2 / 3 + 0 + 0) / 3)


def test_segment_values_match_as_numbers(spark):
    rows = spark.createDataFrame([("id_bodega", "1.0", 4, 2.0)], "segment_column string, segment_value string, n bigint, MAE double")
    new = spark.createDataFrame([("id_bodega", "1", 5, 1.5)], "segment_column string, segment_value string, n bigint, MAE double")
    got = compare.segment_comparison(rows, new, [("id_bodega", 1), ("clima", "x")]).orderBy("segment_column").collect()
    assert got[0]["improved"] is False and got[0]["delta_MAE"] is None
    assert got[1]["improved"] is True and got[1]["n"] == 5


def test_ridge_matches_the_closed_form(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 2))
    y = x @ [1.0, -2.0] + rng.normal(size=60)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y)], ["features", "y"])
    c = x - x.mean(axis=0)
    want = np.linalg.solve(c.T @ c + 3.0 * np.eye(2), c.T @ (y - y.mean()))
    got = learners.ridge(df, 3.0, "y").fit(df)
    assert got.coefficients.toArray() == pytest.approx(want, abs=1e-5)


def test_huber_and_residual_models_beat_the_mean(spark):
    df = spark.range(200).select((F.col("id") % 20 * 1.0).alias("x"), (F.col("id") % 20 * 2.0 + F.col("id") % 3).alias("y"))
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    fits = {
        "huber": learners.huber("y", rounds=12, rate=0.3).fit(data),
        "both": learners.fit_residual_correction(data, learners.tree("y", 2), learners.tree("y", 2), "y"),
    }
    got = {r["model"]: r["R2"] for r in score.reg_metrics(learners.predict_long(fits, data, "y", [])).collect()}
    assert min(got.values()) > 0.8


def test_search_choices():
    assert search.choose_points({"a": [1, 2]}) == ("grid", [{"a": 1}, {"a": 2}])
    method, points = search.choose_points({"a": list(range(20)), "b": list(range(20))}, draws=30)
    assert method == "randomized" and len(points) == 30 == len({tuple(p.items()) for p in points})
    assert len(search.GRIDS) == 7 and len(search.SPACES) == 6 and len(search.CLASS_SPACES) == 2
    with pytest.raises(ValueError):
        search.grid_for("unknown")


def test_folds_respect_the_smallest_class(spark):
    df = column(spark, ["a"] * 6 + ["b"] * 3, "c", "string")
    assert prep.effective_folds(df, "c", 5) == 3
    with pytest.raises(ValueError):
        prep.effective_folds(df.where("c = 'a'"), "c", 5)


def test_failing_model_leaves_its_error(spark):
    df = spark.range(40).select(F.col("id").alias("split_key"), (F.col("id") * 1.0).alias("x"), (F.col("id") * 2.0).alias("target_tiempo_entrega"))
    folds = search.encoded_folds(prep.assign_folds(df, 2), ["x"], [], 2, ["target_tiempo_entrega"])
    got = {r["model"]: r for r in search.cross_validate({"ok": learners.linear(), "bad": learners.linear("absent")}, folds).collect()}
    assert got["ok"]["cv_error"] == "" and got["ok"]["cv_rmse_mean"] == pytest.approx(0, abs=1e-6)
    assert got["bad"]["cv_rmse_mean"] is None and got["bad"]["cv_error"]


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0.0, "a"), (1.0, "a"), (2.0, "b"), (3.0, "b")], "x double, categoria_entrega string")
    encoder = prep.fit_encoder(df, ["x"], [])
    fitted = learners.fit_classifier(encoder.transform(df), learners.DecisionTreeClassifier(maxDepth=2), "categoria_entrega")
    whole = learners.full_model(encoder, fitted)
    path = models.save_model(whole, str(tmp_path), "modelo")
    again = models.load_model(spark, path).transform(df.select("x"))
    assert [r["predicho"] for r in again.orderBy("x").collect()] == ["a", "a", "b", "b"]
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError):
        models.save_model(whole, str(tmp_path), " ")


def test_csv_sources(spark, tmp_path):
    (tmp_path / "b.csv").write_bytes("﻿clima,Distancia KM\nLluvia,\"3,5\"\n".encode())
    (tmp_path / "a.csv").write_text("clima\nx\n")
    df = clean.normalize_columns(tables.scan_csv(spark, str(tmp_path / "b.csv")))
    assert clean.parse_numeric(df, ["distancia_km"]).collect() == [("Lluvia", 3.5)]
    assert tables.discover_csv(spark, str(tmp_path), "b.csv").endswith("b.csv")
    with pytest.warns(UserWarning):
        assert tables.discover_csv(spark, str(tmp_path), "z.csv").endswith("a.csv")
    with pytest.raises(FileNotFoundError):
        tables.scan_csv(spark, str(tmp_path / "absent.csv"))


def test_cluster_scores_by_hand(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([0.0, 0.0]), 0), (Vectors.dense([0.0, 2.0]), 0), (Vectors.dense([10.0, 0.0]), 1), (Vectors.dense([10.0, 2.0]), 1)]
    got = cluster.cluster_indexes(spark.createDataFrame(rows, ["features", "cluster"]))
    assert got == pytest.approx({"inertia": 4.0, "calinski_harabasz_score": 50.0, "davies_bouldin_score": 0.2})


def test_report_text():
    text = flows.final_report({"MAE": 1.5}, "ridge", compared=True)
    assert "| MAE | 1.500000 |" in text and "Modelo final: ridge" in text
