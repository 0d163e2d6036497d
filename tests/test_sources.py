import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelcast import session
from panelcast.functions import columns as C
from panelcast.operators import aggregates, features, joins
from panelcast.sources import readers, schema, writers


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_segments_with_either_separator(spark, tmp_path):
    a = write(tmp_path / "a.csv", " Family_Name ;Segment\nBREAD;High\nBOOKS;Ultra Low\n")
    b = write(tmp_path / "b.csv", "family,my segment\nBREAD,High\nBOOKS,Ultra-low\n")
    want = [("BOOKS", "Ultra-low"), ("BREAD", "High")]
    for path in (a, b):
        assert [tuple(r) for r in readers.read_segments(spark, path).orderBy("family").collect()] == want


def test_panel_types_and_missing_columns(spark, tmp_path):
    path = write(tmp_path / "p.csv", "date,store_nbr,family,sales,extra,dcoilwtico\n2000-01-01,1,A,2.5,7,NaN\n")
    df = readers.read_panel(spark, path)
    assert dict(df.dtypes)["date"] == "date" and dict(df.dtypes)["extra"] == "string"
    assert df.first()["dcoilwtico"] is None
    with pytest.raises(ValueError, match="sales"):
        readers.read_panel(spark, write(tmp_path / "q.csv", "date,store_nbr,family\n2000-01-01,1,A\n"))


def test_fold_pairs(spark, tmp_path):
    row = "date,store_nbr,family,sales\n2000-01-0{i},1,A,{i}.0\n"
    for i in (1, 2):
        for split in ("train", "test"):
            write(tmp_path / f"{split}_fold_{i}.csv", row.format(i=i))
    write(tmp_path / "train_fold_3.csv", row.format(i=3))
    got = readers.read_folds(spark, str(tmp_path), [1, 2, 3, 4])
    assert sorted((r["fold"], r["split"], r["sales"]) for r in got.collect()) == [
        (1, "test", 1.0), (1, "train", 1.0), (2, "test", 2.0), (2, "train", 2.0)]


def test_columns_are_matched_by_name(spark, tmp_path):
    write(tmp_path / "train_fold_1.csv", "date,store_nbr,family,sales,onpromotion\n2000-01-01,1,A,5.0,7\n")
    write(tmp_path / "test_fold_1.csv", "onpromotion,sales,date,store_nbr,family,cluster\n3,2.0,2000-01-02,1,A,4\n")
    want = [("test", 2.0, 3, 4), ("train", 5.0, 7, None)]
    columns = ["split", "sales", "onpromotion", "cluster"]
    got = readers.read_folds(spark, str(tmp_path), [1]).select(*columns)
    assert sorted(tuple(r) for r in got.collect()) == want
    paths = [str(tmp_path / f"{s}_fold_1.csv") for s in ("train", "test")]
    assert sorted(r["sales"] for r in readers.read_panel(spark, paths).where("onpromotion in (3, 7)").collect()) == [2.0, 5.0]
    with pytest.raises(Exception, match="header"):
        readers.read_panel(spark, str(tmp_path)).collect()


def test_tagged_files(spark, tmp_path):
    a = write(tmp_path / "a.csv", "family,MAE\nA,1\n")
    got = readers.read_tagged(spark, {a: "x", str(tmp_path / "none.csv"): "y"})
    assert [tuple(r) for r in got.collect()] == [("A", 1, "x")]
    with pytest.raises(Exception):
        readers.read_tagged(spark, {a: "x", str(tmp_path / "none.csv"): "y"}, on_missing="raise")
    with pytest.raises(FileNotFoundError):
        readers.read_tagged(spark, {str(tmp_path / "none.csv"): "y"})


def test_read_matching_and_find(spark, tmp_path):
    for i in (1, 2):
        write(tmp_path / f"d{i}" / f"predictions_fold{i}.csv", f"family,y_true\nA,{i}\n")
    write(tmp_path / "d1" / "other.csv", "family,y_true\nB,9\n")
    got = readers.read_matching(spark, str(tmp_path), "predictions_fold*.csv", "fold", r"fold(\d+)\.csv",
                                "family string, y_true double")
    assert sorted((r["fold"], r["y_true"]) for r in got.collect()) == [("1", 1.0), ("2", 2.0)]
    assert readers.find_inputs(spark, str(tmp_path), "*_fold1.csv").count() == 1
    empty = readers.read_matching(spark, str(tmp_path), "absent*.csv", "fold", r"(\d+)", "family string")
    assert empty.count() == 0


def test_align_schema(spark):
    master = spark.createDataFrame([], "a int, b double, c string").schema
    got = schema.align_schema(spark.createDataFrame([("x", 1, 2)], "c string, a int, z int"), master)
    assert got.columns == ["a", "b", "c"] and got.first() == (1, None, "x")


def test_upsert_leaves_other_models(spark, tmp_path):
    base = str(tmp_path / "table")
    old = spark.createDataFrame([("X", 1.0), ("Y", 2.0)], "model string, MAE double")
    writers.upsert_table(spark, base, old, "model")
    got = writers.upsert_table(spark, base, spark.createDataFrame([("X", 9.0)], "model string, MAE double"), "model")
    assert sorted(tuple(r) for r in got.collect()) == [("X", 9.0), ("Y", 2.0)]
    assert writers.latest(spark, base)[1] == 2


def test_state(spark, tmp_path):
    df = spark.createDataFrame([(1.0,)], "a double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="v")]).fit(df)
    assert isinstance(writers.load_state(spark, writers.save_state(model, str(tmp_path / "m"))), PipelineModel)
    assert writers.load_state(spark, writers.save_state(df, str(tmp_path / "t"))).first()["a"] == 1.0


def test_report_formats(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.23456, [1, 0, 2])], "family string, MAE double, Order array<int>")
    path = writers.write_report(df, str(tmp_path / "r"), 4)
    assert spark.read.option("header", True).csv(path).first() == ("A", "1.2346", "(1, 0, 2)")


def test_null_cells_are_empty(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.0), ("B", None)], "family string, MAE double")
    path = writers.write_report(df, str(tmp_path / "r"))
    lines = {r[0] for r in spark.read.text(path).collect()}
    assert lines == {"family,MAE", "A,1.0000", "B,"}


def test_folds_prune_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", 1.0), (2, "test", 2.0)], "fold int, split string, x double")
    table = readers.read_fold_table(spark, writers.write_folds(df, str(tmp_path / "f")))
    plan = table.where("fold = 2 and split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fold" in plan
    assert table.where("fold = 2").count() == 1


def test_tables_go_to_the_shared_folder(spark):
    path = session.new_path(spark, "t")
    assert path.startswith(session.shared_dir(spark)) and path != session.new_path(spark, "t")
    assert session.shared_dir(spark) in session.materialize(spark.range(3)).inputFiles()[0]


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class _Session:
    """Stands in for a session with a given master and checkpoint folder."""

    def __init__(self, master, configured):
        self.conf, self.sparkContext, self.master = _Conf(configured), self, master

    def getCheckpointDir(self):
        return None


def test_shared_folder_rules():
    assert session.shared_dir(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session("yarn", None))


def test_null_rules(spark):
    df = spark.createDataFrame([(None, 1), (-2.0, 1), (3.0, None)], "a double, b int")
    got = [r[0] for r in df.select(C.clip_lower("a")).collect()]
    assert got == [None, 0.0, 3.0]
    assert [r["f"] for r in features.add_flag(df, F.col("a") > 0, "f").collect()] == [0, 0, 1]
    assert features.drop_nulls(df).count() == 1 and features.drop_nulls(df, ["a"]).count() == 2
    assert features.null_columns(df, ["a", "b"]) == ["a", "b"]
    text = spark.createDataFrame([(None, None)], "t string, n double")
    assert features.fill_constants(text, 0).first() == ("0", 0.0)
    assert features.fill_constants(text, 0, "missing").first() == ("missing", 0.0)


def test_sum_of_nulls_is_zero(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(2000, 1, 1), "A", None, None, 0, None)],
                               "date date, family string, sales double, onpromotion int, is_holiday int, dcoilwtico double")
    row = aggregates.daily_rollup(df).first()
    assert row["sales"] == 0 and row["onpromotion"] == 0 and row["dcoilwtico"] is None


def test_weights_default_to_one(spark):
    df = spark.createDataFrame([("A",), ("B",)], "family string")
    weights = spark.createDataFrame([("A", 2.5)], "family string, weight double")
    assert sorted((r["family"], r["weight"]) for r in joins.map_weight(df, weights).collect()) == [("A", 2.5), ("B", 1.0)]


def test_safe_name(spark):
    df = spark.createDataFrame([("BREAD/BAKERY X",)], "f string")
    assert df.select(C.safe_name("f")).first()[0] == "BREAD_BAKERY_X"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_goes_on_after_a_failed_run(spark, tmp_path):
    base = str(tmp_path / "table")
    first = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "model string, mae double")
    writers.upsert_table(spark, base, first, "model")
    failing = spark.createDataFrame([("a", "x")], "model string, t string").select("model", F.col("t").cast("double").alias("mae"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        writers.upsert_table(spark, base, failing, "model")
    assert _rows(writers.latest(spark, base)[0]) == [("a", 1.0), ("b", 2.0)]
    got = writers.upsert_table(spark, base, spark.createDataFrame([("a", 3.0)], "model string, mae double"), "model")
    assert _rows(got) == [("a", 3.0), ("b", 2.0)] and writers.versions(spark, base) == [1, 2]
    assert _rows(writers.read_version(spark, base, 1)) == [("a", 1.0), ("b", 2.0)]


def test_an_empty_table_has_a_version(spark, tmp_path):
    base = str(tmp_path / "table")
    empty = spark.createDataFrame([], "model string, mae double")
    assert writers.latest(spark, base) == (None, 0)
    assert writers.upsert_table(spark, base, empty, "model").count() == 0
    assert writers.latest(spark, base)[1] == 1
    wider = spark.createDataFrame([("a", 1.0, 2)], "model string, mae double, n int")
    assert _rows(writers.upsert_table(spark, base, wider, "model")) == [("a", 1.0, 2)]


def test_a_taken_version_is_not_replaced(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "table")
    schema = "model string, mae double"
    writers.upsert_table(spark, base, spark.createDataFrame([("a", 1.0)], schema), "model")
    real, other = writers.commit, [spark.createDataFrame([("b", 2.0)], schema)]

    def late(*args):
        # Another writer commits between this one's reading and its marker.
        if other:
            monkeypatch.setattr(writers, "commit", real)
            writers.upsert_table(spark, base, other.pop(), "model")
            monkeypatch.setattr(writers, "commit", late)
        return real(*args)

    monkeypatch.setattr(writers, "commit", late)
    got = writers.upsert_table(spark, base, spark.createDataFrame([("c", 3.0)], schema), "model")
    assert _rows(got) == [("a", 1.0), ("b", 2.0), ("c", 3.0)] and writers.versions(spark, base) == [1, 2, 3]


def test_writers_at_the_same_time_lose_no_rows(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    base = str(tmp_path / "table")

    def write(k):
        return writers.upsert_table(spark, base, spark.createDataFrame([(f"m{k}", float(k))], "model string, mae double"), "model")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    assert _rows(writers.latest(spark, base)[0]) == [(f"m{k}", float(k)) for k in range(4)]
