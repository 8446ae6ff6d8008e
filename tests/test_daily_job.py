from pyspark.sql import functions as F

from ebbwatch.operators.clean import clean_activity
from ebbwatch.operators.sketches import estimated_users
from ebbwatch.plans.daily_job import main, take_in
from ebbwatch.plans.features import user_features
from ebbwatch.sources.activity_log import write_json_log
from ebbwatch.sources.star_tables import activity_log
from tests.test_cubes_and_batches import sorted_rows


def test_batches_give_what_the_whole_log_gives(spark, sf_dir, tmp_path):
    log = activity_log(spark, sf_dir).persist()
    parts = {"b0": F.dayofmonth(F.timestamp_millis("ts")) < 10, "b1": F.dayofmonth(F.timestamp_millis("ts")) >= 10}
    for name, part in parts.items():
        write_json_log(log.where(part), f"{tmp_path}/lines/{name}")
    (tmp_path / "lines" / "b1" / "broken.json").write_text('{"ts": "soon", "userId": "1"}\n{"cut\n')
    store = f"{tmp_path}/store"
    take_in(spark, f"{tmp_path}/lines/b1", store, "b1")  # in any order, and more than once
    take_in(spark, f"{tmp_path}/lines/b0", store, "b0")
    found = take_in(spark, f"{tmp_path}/lines/b1", store, "b1")
    clean = clean_activity(log)
    assert sorted_rows(found.log) == sorted_rows(clean)
    assert sorted_rows(found.features) == sorted_rows(user_features(clean))
    assert {tuple(r) for r in found.broken.collect()} == {("b1", "type of ts", 1), ("b1", "not JSON", 1)}
    drift = {r.column_name: r.status for r in found.drift.collect()}
    assert drift.pop("ts") == "changed" and set(drift.values()) == {"same"}
    users = clean.select("userId").distinct().count()
    assert abs(estimated_users(found.sketches).first().n_users - users) <= max(1, 0.03 * users)
    log.unpersist()


def test_job_explains_its_arguments(capsys):
    assert main([]) == 2
    assert "BATCH" in capsys.readouterr().out
