from ebbwatch.plans.training_job import main, train
from ebbwatch.sources.activity_log import RAW_SCHEMA, read_json_log, write_json_log
from ebbwatch.sources.star_tables import activity_log


def test_job_from_json_to_rules(spark, tmp_path):
    log = activity_log(spark, "/root/testdata/sf0.01")
    write_json_log(log, f"{tmp_path}/log")
    assert read_json_log(spark, f"{tmp_path}/log").schema == RAW_SCHEMA
    results = train(spark, f"{tmp_path}/log", f"{tmp_path}/out", max_depth=[5])
    assert {r.metric for r in results["test_metrics"].collect()} >= {"f1", "accuracy", "auc"}
    assert results["comparison"].where("model = 'decision_tree'").count() == 8
    assert results["rules"].count() == results["leaves"].count() > 1
    # 150 users, whatever becomes of them later on.
    features = spark.read.csv(f"{tmp_path}/out/features_csv", header=True)
    assert features.count() == 150 and "avg_daily_ThumbsUp" in features.columns
    assert (tmp_path / "out" / "clean_log" / "date=2024-01-02").is_dir()
    # A second run into the same folder replaces the tables and gives the same.
    first = {name: sorted(map(str, table.collect())) for name, table in results.items()}
    again = train(spark, f"{tmp_path}/log", f"{tmp_path}/out", max_depth=[5])
    assert {name: sorted(map(str, table.collect())) for name, table in again.items()} == first


def test_job_explains_its_arguments(capsys):
    assert main([]) == 2
    assert "LOG_PATH" in capsys.readouterr().out
