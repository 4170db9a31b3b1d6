from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from customer_data import SCHEMA, row, rows, table, write_csv
from rowan.operators import mlp, tuning
from rowan.operators.mlp import MLPModel, NetworkSettings
from rowan.operators.scoring import score
from rowan.plans.scoring import run_scoring
from rowan.plans.training import TrainingSettings, run_training
from rowan.sources.models import load_model, save_model
from rowan.sources.runs import SCHEMAS, RunStore, new_run_id
from rowan.sources.tables import read_raw, write_snapshot
from rowan.spec import CUSTOMER_SPEC
from rowan.streaming.scoring import score_new_files

SMALL = TrainingSettings(
    cv_folds=3,
    network=NetworkSettings(
        epochs=6, batch_size=4, hidden_dims=(16, 8), validation_split=0.25, early_stopping_patience=2
    ),
    models={"random_forest": {"n_estimators": 10, "max_depth": 4}},
)
FAMILIES = ["logistic_regression", "random_forest", "torch_mlp"]


@pytest.fixture(scope="module")
def first_run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("runs")
    source = write_csv(root / "in.csv", rows(80))
    return str(root / "out"), source, run_training(spark, source, CUSTOMER_SPEC, f"{root}/out", SMALL)


def test_training_run_is_recorded(spark, first_run):
    root, _, summary = first_run
    store = RunStore(spark, root)
    metrics = store.latest("metrics").collect()
    assert {r["model"] for r in metrics if r["section"] == "test"} == set(FAMILIES)
    for family in FAMILIES[:2]:
        cells = [r for r in metrics if r["model"] == family and "cross" in r["section"]]
        assert len(cells) == 10
    training = {r["metric"]: r["value"] for r in metrics if r["section"] == "training"}
    assert training["train_rows"] + training["validation_rows"] == 64
    assert training["epochs_completed"] == store.latest("history").count() >= 1
    thresholds = store.latest("thresholds")
    assert thresholds.filter("kind = 'grid'").count() == 17
    assert thresholds.filter("kind = 'best_f1'").first()["threshold"] >= 0.1
    assert (summary["dataset_rows"], summary["train_rows"], summary["test_rows"]) == (80, 64, 16)
    stored = store.latest("summary").first()
    manifest = store.latest("manifest").first()
    assert stored["selected_model"] == manifest["selected_model"] == summary["selected_model"]
    assert stored["models_evaluated"] == FAMILIES
    assert json.loads(manifest["config"])["test_size"] == 0.2
    assert spark.read.parquet(manifest["artifact_paths"]["dataset"]).count() == 80
    assert store.read("drift").count() == 0


@pytest.mark.parametrize("family", FAMILIES)
def test_every_family_scores_after_reload(spark, first_run, tmp_path, family):
    _, source, summary = first_run
    model = summary["result"].models[family]
    path = save_model(spark, model, str(tmp_path / "best_model"))
    odd = [row(1), row(2, Contract="Weekly", TotalCharges="x"), row(3, Churn=None)]
    raw = table(spark, odd).drop("customerID", "Churn").withColumn("probability", F.lit("kept"))
    direct = score(model, raw, CUSTOMER_SPEC).collect()
    again = score(load_model(spark, path), raw, CUSTOMER_SPEC)
    assert again.collect() == direct
    assert again.columns == [*raw.columns, "churn_probability", "predicted_churn"]
    assert all(0 <= r["churn_probability"] <= 1 and r["probability"] == "kept" for r in direct)
    for r in score(model, raw, CUSTOMER_SPEC, threshold=0.3).collect():
        assert r["predicted_churn"] == int(r["churn_probability"] >= 0.3)
    out = run_scoring(spark, path, source, str(tmp_path / "out"), CUSTOMER_SPEC, target_fmt="csv")
    written = spark.read.option("header", True).csv(out)
    assert written.count() == 80
    assert written.columns[-2:] == ["churn_probability", "predicted_churn"]
    plan = score(model, raw, CUSTOMER_SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_unknown_model_kind(spark):
    with pytest.raises(ValueError, match="Unsupported model artifact"):
        load_model(spark, "/nowhere/model.bin")


def test_second_run_is_compared_and_failed_runs_hide_older_ones(spark, first_run, tmp_path):
    root, _, summary = first_run
    quick = TrainingSettings(
        cv_enabled=False,
        network=NetworkSettings(enabled=False),
        models={"random_forest": {"enabled": False}},
    )
    more = [row(i, gender=None if i % 10 == 0 else "Male") for i in range(95)]
    second = run_training(spark, write_csv(tmp_path / "b.csv", more), CUSTOMER_SPEC, root, quick)
    store = RunStore(spark, root)
    found = store.latest("drift").collect()
    assert second["has_drift"] and {r["previous_run_id"] for r in found} == {summary["run_id"]}
    assert {(r["check"], r["column"]) for r in found if r["flagged"]} >= {
        ("row_count", None), ("missing_rate", "gender"),
    }
    bad = write_csv(tmp_path / "c.csv", [row(1), row(1)])
    with pytest.raises(ValueError, match="Duplicate"):
        run_training(spark, bad, CUSTOMER_SPEC, root, quick)
    later = new_run_id() + "z"
    assert store.previous_pair(later).count() == 0
    pair = store.previous_pair(later, skip_failed=True).first()
    assert pair["previous_run_id"] == second["run_id"]
    assert store.latest("summary").first()["run_id"] == second["run_id"]


def test_snapshots_are_never_overwritten(spark, tmp_path):
    df = table(spark, rows(2))
    write_snapshot(df, str(tmp_path), "r1")
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        write_snapshot(df, str(tmp_path), "r1")


def test_tuned_run_feeds_the_final_models(spark, tmp_path, monkeypatch):
    space = {"n_estimators": (4, 8), "max_depth": (2, None), "min_samples_leaf": (1, 2)}
    monkeypatch.setattr(tuning, "FOREST_SPACE", space)
    settings = TrainingSettings(
        tuning_enabled=True,
        tuning_samples=3,
        tuning_folds=2,
        cv_enabled=False,
        network=NetworkSettings(enabled=False),
    )
    source = write_csv(tmp_path / "in.csv", rows(60))
    result = run_training(spark, source, CUSTOMER_SPEC, str(tmp_path / "out"), settings)["result"]
    tuned = {r["model"]: r for r in RunStore(spark, str(tmp_path / "out")).latest("tuning").collect()}
    assert set(tuned) == {"logistic_regression", "random_forest"}
    for model, row in tuned.items():
        best = json.loads(row["best_params"])
        assert row["num_trials"] == 3 and 0 <= row["best_f1_mean"] <= 1
        assert {k: result.settings[model][k] for k in best} == best


class _Killed(Exception):
    pass


def test_a_run_that_ends_between_two_tables_shows_in_none(spark, first_run, monkeypatch):
    quick = TrainingSettings(
        cv_enabled=False,
        network=NetworkSettings(enabled=False),
        models={"random_forest": {"enabled": False}},
    )
    root, source, _ = first_run
    store = RunStore(spark, root)
    committed = store.committed()
    before = {t: store.read(t).collect() for t in SCHEMAS if t != "runs"}
    append = RunStore.append
    for last in ("quality", "manifest"):

        def killed(self, table, rows, last=last):
            append(self, table, rows)
            if table == last:
                raise _Killed

        monkeypatch.setattr(RunStore, "append", killed)
        with pytest.raises(_Killed):
            run_training(spark, source, CUSTOMER_SPEC, root, quick)
        monkeypatch.undo()
        store = RunStore(spark, root)
        lost = store.run_ids("runs")[-1]
        assert lost not in committed and store.committed() == committed
        assert {t: store.read(t).collect() for t in before} == before
        assert lost not in {r["run_id"] for t in before for r in store.latest(t).collect()}
        assert store.of_run(last, lost).isEmpty()


def test_an_interrupted_run_is_continued(spark, first_run, tmp_path, monkeypatch):
    root, source, summary = first_run
    taken = []
    train_epoch = mlp._Dealt.train

    def counted(self, state):
        if len(taken) == 2:
            raise _Killed
        taken.append(self.epoch.epoch)
        return train_epoch(self, state)

    out = str(tmp_path / "out")
    monkeypatch.setattr(mlp._Dealt, "train", counted)
    with pytest.raises(_Killed):
        run_training(spark, source, CUSTOMER_SPEC, out, SMALL)
    monkeypatch.undo()
    stopped = RunStore(spark, out).run_ids("runs")[-1]
    done = []
    monkeypatch.setattr(mlp._Dealt, "train", lambda self, s: done.append(self.epoch.epoch) or train_epoch(self, s))
    again = run_training(spark, None, CUSTOMER_SPEC, out, SMALL, continues=stopped)
    assert done[0] == 3
    history = lambda r: [(e["epoch"], e["train_loss"]) for e in r["result"].history.collect()]
    assert history(again) == history(summary)


def test_new_files_are_scored_once(spark, first_run, tmp_path):
    model = first_run[2]["result"].models["logistic_regression"]
    source, out, progress = (str(tmp_path / name) for name in ("in", "out", "progress"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for batch, expected in ((rows(5), 5), (rows(3), 8), ([], 8)):
        if batch:
            table(spark, batch).write.mode("append").parquet(source)
        score_new_files(spark, model, source, schema, out, progress, CUSTOMER_SPEC)
        assert spark.read.parquet(out).count() == expected
    scored = {r["customerID"]: r["churn_probability"] for r in spark.read.parquet(out).collect()}
    direct = score(model, table(spark, rows(5)), CUSTOMER_SPEC).collect()
    assert scored == {r["customerID"]: r["churn_probability"] for r in direct}


def test_network_model_type(first_run):
    assert isinstance(first_run[2]["result"].models["torch_mlp"], MLPModel)


def test_csv_records_are_read_whole_or_refused(spark, tmp_path):
    whole = tmp_path / "whole.csv"
    whole.write_text('a,b,c\n1,"line one\nline two",x\n2,"say ""hi"", then",y\n3,,z\n')
    rows_read = read_raw(spark, str(whole)).orderBy("a").collect()
    assert [tuple(r) for r in rows_read] == [
        ("1", "line one\nline two", "x"), ("2", 'say "hi", then', "y"), ("3", None, "z"),
    ]
    surplus = tmp_path / "surplus.csv"
    surplus.write_text("a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|Malformed"):
        read_raw(spark, str(surplus)).collect()
    loose = read_raw(spark, str(surplus), options={"mode": "PERMISSIVE"})
    assert loose.count() == 2


def test_reader_options_pass_through_the_flows(spark, first_run, tmp_path):
    _, source, summary = first_run
    odd = tmp_path / "semicolons.csv"
    odd.write_text(open(source).read().replace(",", ";"))
    out = run_scoring(
        spark, summary["best_model_artifact"], str(odd), str(tmp_path / "out"), CUSTOMER_SPEC,
        reader={"sep": ";"},
    )
    assert spark.read.parquet(out).count() == 80
    broken = tmp_path / "broken.csv"
    broken.write_text(open(source).read() + "too,few\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|Malformed"):
        run_training(spark, None, CUSTOMER_SPEC, str(tmp_path / "runs"), SMALL, fallback=str(broken))


def test_unexpected_values_of_a_refused_run_are_kept(spark, tmp_path):
    root = str(tmp_path / "runs")
    bad = write_csv(tmp_path / "in.csv", [row(1, gender="X"), row(2, gender="X"), row(3, Churn="Maybe")])
    with pytest.raises(ValueError, match="Unexpected categorical"):
        run_training(spark, bad, CUSTOMER_SPEC, root, SMALL)
    found = RunStore(spark, root).latest("unexpected").collect()
    assert {(r["column"], r["value"], r["n"]) for r in found} == {("gender", "X", 2), ("Churn", "Maybe", 1)}


def test_reading_a_run_prunes_the_others(spark, first_run):
    store = RunStore(spark, first_run[0])
    plan = store.latest("quality")._jdf.queryExecution().executedPlan().toString()
    newest = store.run_ids("quality")[-1]
    assert re.search(rf"PartitionFilters: \[[^]]*{newest}", plan)


# The 12 rows by rule: two classes of six, five requested folds clamp to four.
def test_twelve_rows_from_end_to_end(spark, tmp_path):
    records = [row(i, Churn="Yes" if i % 2 else "No") for i in range(12)]
    settings = TrainingSettings(
        network=NetworkSettings(epochs=2, batch_size=4, hidden_dims=(8,), validation_split=0.25),
        models={"random_forest": {"n_estimators": 5, "max_depth": 3}},
    )
    source = write_csv(tmp_path / "in.csv", records)
    summary = run_training(spark, source, CUSTOMER_SPEC, str(tmp_path / "out"), settings)
    assert (summary["dataset_rows"], summary["train_rows"], summary["test_rows"]) == (12, 9, 3)
    result = summary["result"]
    assert result.cross_validation.select("fold").distinct().count() == 4
    training = result.models["torch_mlp"].summary
    assert (training.train_rows, training.validation_rows) == (6, 3)
