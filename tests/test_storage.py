import pytest

from lineforge import storage
from lineforge.sinks import create_layers, write_table


class FakeSession:
    def __init__(self, **conf):
        self.settings = conf
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_named_folder_is_used(spark):
    assert storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert storage.work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(FakeSession(**{"spark.master": "yarn", "spark.app.id": "a"}))


def test_local_session_without_folder_gets_its_own_once():
    session = FakeSession(**{"spark.master": "local[2]", "spark.app.id": "some-app"})
    assert storage.shared_folder(session) == storage.shared_folder(session)


def test_shuffles_grow_with_the_data_but_never_shrink():
    session = FakeSession(**{"spark.sql.shuffle.partitions": "200"})
    storage.fit_shuffle(session, 1_000_000)
    assert storage.shuffle_tasks(session) == 200
    storage.fit_shuffle(session, 2_000_000_000)
    assert storage.shuffle_tasks(session) == 1000
    storage.fit_shuffle(session, 5)
    assert storage.shuffle_tasks(session) == 1000
    storage.fit_shuffle(session, 500_000_000_000)
    assert storage.shuffle_tasks(session) == storage.MAX_SHUFFLE_TASKS


def test_materialise_keeps_schema_and_rows(spark):
    df = spark.sql("SELECT id, TIMESTAMP_NTZ'2020-01-01 00:00:00' AS t, CAST(1.5 AS DECIMAL(9,2)) AS d FROM range(3)")
    kept = storage.materialise(df, "kept")
    assert kept.dtypes == df.dtypes and sorted(kept.collect()) == df.collect()
    assert all(storage.work_folder(spark) in path for path in kept.inputFiles())


def test_layers_and_full_refresh(spark, tmp_path):
    create_layers(spark, ["t_silver"], str(tmp_path))
    create_layers(spark, ["t_silver"], str(tmp_path))
    write_table(spark.range(5), "t_silver.numbers")
    table = write_table(spark.createDataFrame([("x",)], "other string"), "t_silver.numbers")
    assert table.columns == ["other"] and table.count() == 1
    assert (tmp_path / "t_silver" / "numbers").is_dir()


def test_a_cluster_on_one_machine_is_a_cluster():
    session = FakeSession(**{"spark.master": "local-cluster[2,1,512]", "spark.app.id": "b"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(session)


def test_stored_tables_are_compressed_by_zstd(spark, tmp_path):
    create_layers(spark, ["z_silver"], str(tmp_path))
    assert all(".zstd." in path for path in write_table(spark.range(5), "z_silver.numbers").inputFiles())
