import pytest
from pyspark.sql import functions as F

from kensa.operators import history as hi
from kensa.session import scratch_path
from kensa.sources import catalog as cat
from kensa.sources import files as fs
from kensa.sources import sink


def _csv(tmp_path):
    p = tmp_path / "labels" / "image_anno.csv"
    p.parent.mkdir(parents=True)
    p.write_text('image,label,mask\n'
                 'Normal/a.png,normal,\n'
                 'Anomaly/b.png,bent,m/b.png\n'
                 'Anomaly/c.png,"bent,scratch",m/c.png\n'
                 ',missing,\n'
                 'Anomaly/d.png,"unclosed,x\n')
    return str(p.parent)


def test_read_labels_keeps_bad_lines(spark, tmp_path):
    rows = fs.read_labels(spark, _csv(tmp_path)).collect()
    assert len(rows) == 5
    two = next(r for r in rows if r.image == "Anomaly/c.png")
    assert two.label == "bent,scratch" and two[fs.CORRUPT] is None
    assert next(r for r in rows if r.label == "missing").image is None
    assert sum(r[fs.CORRUPT] is not None for r in rows) == 1


def test_image_bytes_metadata_scan_skips_content(spark, image_tree):
    root, files = image_tree
    listing = fs.read_image_bytes(spark, str(root)).select("path", "length")
    assert listing.count() == len(files) + 1  # the glob selects by name: broken.jpg too
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_folder_checks(spark, image_tree, tmp_path):
    root, files = image_tree
    assert fs.folder_is_empty(spark, str(tmp_path / "nope")) is True
    (tmp_path / "empty").mkdir()
    assert fs.folder_is_empty(spark, str(tmp_path / "empty")) is True
    assert fs.folder_is_empty(spark, str(root)) is False
    assert fs.any_folder_empty(spark, [str(root), str(tmp_path / "nope")]) is True
    counts = {r.folder.rsplit("/", 1)[1]: r.n_files for r in fs.file_counts(spark, str(root)).collect()}
    assert counts == {"Normal": 4, "Anomaly": 4}


def test_schema_tables_and_catalogs(spark, image_tree, tmp_path):
    db = "kensa_test_db"
    cat.setup_schema(spark, db, reset=True)
    try:
        fs.ingest_files(spark, str(image_tree[0]), f"{db}.images")
        names = {r.tableName for r in cat.list_tables(spark, db).collect()}
        assert "images" in names
        assert spark.table(f"{db}.images").where(F.col("key").endswith(".png")).count() == len(image_tree[1])
        cat.setup_schema(spark, db, reset=True)
        assert cat.list_tables(spark, db).count() == 0
        cur = [r for r in cat.list_catalogs(spark).collect() if r.is_current]
        assert cur and cur[0].catalog == "spark_catalog"
        with pytest.raises(ValueError):
            cat.setup_schema(spark, db, catalog="spark_catalog", reserved=("spark_catalog",))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
        spark.catalog.setCurrentDatabase("default")


def test_ensure_loaded_then_kept(spark, image_tree, tmp_path):
    db = "kensa_load_db"
    cat.setup_schema(spark, db, reset=True)
    try:
        cfg = cat.LoadConfig(str(image_tree[0]), _csv(tmp_path), f"{db}.images", f"{db}.labels")
        assert cat.ensure_loaded(spark, cfg) == "loaded"
        assert cat.ensure_loaded(spark, cfg) == "kept"
        cfg.reset = True
        assert cat.ensure_loaded(spark, cfg) == "loaded"
        assert spark.table(f"{db}.labels").count() == 5
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
        spark.catalog.setCurrentDatabase("default")


def test_wait_for_table(spark):
    with pytest.raises(TimeoutError):
        cat.wait_for_table(spark, "kensa_never_there", timeout=1.0, poll=0.2)
    spark.range(3).write.mode("overwrite").option("path", scratch_path(spark, "w")).saveAsTable("kensa_waited")
    cat.wait_for_table(spark, "kensa_waited", timeout=5.0, poll=0.2)
    spark.sql("DROP TABLE kensa_waited")


def test_history_append_clear_and_overwrite_twice(spark):
    name = "kensa_history"
    hist = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], hi.HISTORY_SCHEMA)
    for _ in range(2):
        cat.overwrite_table(hist, name)
    assert spark.table(name).count() == 2
    new = hi.next_turns(spark.table(name), "user", F.lit("again"))
    hi.append_turns(spark.table(name), new).write.mode("overwrite").option(
        "path", scratch_path(spark, "hist")).saveAsTable(name + "_2")
    assert sorted(r.turn for r in spark.table(name + "_2").collect()) == [0, 1, 2]
    hi.clear_history(spark, name)
    assert spark.table(name).count() == 0 and spark.table(name).columns == ["conv_id", "turn", "role", "text"]
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP TABLE {name}_2")


def test_write_split_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "k int, split string")
    p = str(tmp_path / "ds")
    cat.write_split(df, p)
    assert {d.name for d in (tmp_path / "ds").iterdir() if d.is_dir()} == {"split=train", "split=val", "split=test"}
    assert spark.read.parquet(p).where("split = 'val'").first().k == 2


def _tree(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file())


def test_files_are_written_whole_or_not_at_all(spark, tmp_path):
    root = tmp_path / "tree"
    df = spark.range(0, 40, 1, 4).selectExpr("concat(if(id % 2 = 0, 'a/', 'b/c/'), id div 2, '.bin') key", "cast(id as string) content")
    sink.write_files(df, f"file://{root}")
    back = fs.read_keyed_images(spark, str(root), glob=None).select("key", F.col("content").cast("string").alias("content"))
    assert sorted(map(tuple, back.collect())) == sorted((r.key, r.content) for r in df.collect())
    before = _tree(root)
    boom = F.udf(lambda i: 1 // (i - 33) and b"x", "binary")
    for bad in (df.withColumn("content", boom(F.col("content").cast("int"))), df.withColumn("key", F.lit("../out")), df.withColumn("key", F.lit(None).cast("string")),
                df.withColumn("key", F.lit("x=1/a")), df.withColumn("content", F.lit(None).cast("binary")), df.withColumn("key", F.lit("same"))):
        for how in (False, True):
            with pytest.raises(Exception):
                sink.write_files(bad, str(root), overwrite=how)
            assert _tree(root) == before and not list(root.glob("_*"))
    new = tmp_path / "new"
    with pytest.raises(Exception):
        sink.write_files(df.withColumn("content", boom(F.col("content").cast("int"))), str(new))
    assert fs.folder_is_empty(spark, str(new))
    sink.write_files(df.where("content < '2'"), str(root), overwrite=True)
    assert len(_tree(root)) == df.where("content < '2'").count()
    sink.write_files(df.limit(0), str(tmp_path / "none"))
    assert fs.folder_is_empty(spark, str(tmp_path / "none"))


def test_a_repeated_task_writes_its_files_once(tmp_path):
    """Two attempts of one task: only the one that is committed is seen."""
    from pyspark.sql import Row
    from unittest import mock
    writer = sink.FileTreeWriter(str(tmp_path), overwrite=False)
    rows = [Row(key="a/1", content=b"x"), Row(key="2", content=b"y")]
    with mock.patch.object(sink.TaskContext, "get", return_value=mock.Mock(partitionId=lambda: 3)):
        lost, done = writer.write(iter(rows)), writer.write(iter(rows))
    assert lost.folder != done.folder and done.files == 2 and not [p for p in tmp_path.iterdir() if p.name[0] != "_"]
    writer.commit([done, None])
    assert _tree(tmp_path) == [f"{done.folder}/2", f"{done.folder}/a/1"]


def test_png_files_are_read_back(spark, image_tree, tmp_path):
    from kensa.operators import images as im
    root, _ = image_tree
    read = fs.read_images(spark, str(root)).withColumn("key", fs.relative_key("image.origin", str(root), encoded=True))
    good = read.where("image.height > 0")
    for level in (0, 6):
        out = str(tmp_path / f"l{level}")
        sink.write_files(im.encode_png(good, level=level), out)
        again = fs.read_images(spark, out).withColumn("key", fs.relative_key("image.origin", out, encoded=True))
        fields = ["key", "image.height", "image.width", "image.nChannels", "image.mode", "image.data"]
        assert good.select(fields).exceptAll(again.select(fields)).count() == 0 and again.count() == good.count() == 6
    broken = im.encode_png(read).where("content is null")
    assert sorted(r.key for r in broken.collect()) == ["Anomaly/broken.jpg", "Normal/notes.txt"]


def test_relative_keys(spark):
    rows = [("file:/r/images/Normal/000.JPG", "Normal/000.JPG"), ("file:///r/images/Anomaly/000.JPG", "Anomaly/000.JPG"), ("file:/r/images/part=1/day=2/a/b=c.png", "a/b=c.png"),
            ("file:/r/images/x y+z%20.png", "x y+z%20.png")]
    df = spark.createDataFrame(rows, "path string, want string")
    for root in ("/r/images", "file:/r/images/", "file:///r/images"):
        assert df.where(fs.relative_key("path", root) != F.col("want")).count() == 0
    one = spark.createDataFrame([("file:///r/images/x%20y+z%2520.png",)], "path string")
    assert one.select(fs.relative_key("path", "/r/images", encoded=True)).first()[0] == "x y+z%20.png"


def test_label_join_moves_no_images(spark):
    from conftest import SF_SMALL
    from kensa.operators import joins as jn
    from kensa.plans.storage_queries import load_labelled
    images, labels = load_labelled(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = jn.label_images(images, labels, "key")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert joined.count() == images.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    names = images.select(F.substring_index("key", "/", -1).alias("name"), "key")
    assert names.groupBy("name").agg(F.count_distinct("key").alias("n")).where("n > 1").count() > 0


def test_ingest_adds_only_new_files(spark, tmp_path):
    root, name, at = tmp_path / "in", "kensa_only_new", scratch_path(spark, "only-new")
    one = spark.createDataFrame([("a/1.png", b"1"), ("b/1.png", b"2")], "key string, content binary")
    sink.write_files(one, str(root))
    try:
        for _ in range(2):
            assert fs.ingest_files(spark, str(root), name, path=at, only_new=True, buckets=4).count() == 2
        sink.write_files(spark.createDataFrame([("c/1.png", b"3")], "key string, content binary"), str(root))
        assert sorted(r.key for r in fs.ingest_files(spark, str(root), name, path=at, only_new=True, buckets=4).collect()) == ["a/1.png", "b/1.png", "c/1.png"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_quarantine_is_written_in_one_pass(spark, tmp_path):
    good, bad = fs.quarantine_labels(spark, _csv(tmp_path), str(tmp_path / "out"))
    assert good.count() == 4 and good.columns == ["image", "label", "mask"]
    (line,) = bad.collect()
    assert line.line == 'Anomaly/d.png,"unclosed,x' and line.file == "image_anno.csv"
    src = tmp_path / "only.csv"
    src.write_text("image,label,mask\n")
    good, bad = fs.quarantine_labels(spark, str(src), str(tmp_path / "out"))
    assert good.count() == bad.count() == 0


def test_empty_check_stops_at_the_first_file(spark, tmp_path, monkeypatch):
    for i in range(50):
        (tmp_path / "deep" / f"d{i}").mkdir(parents=True)
        (tmp_path / "deep" / f"d{i}" / "f").write_text("x")
    (tmp_path / "hidden" / "_tmp").mkdir(parents=True)
    (tmp_path / "hidden" / "_tmp" / "f").write_text("x")
    (tmp_path / "hidden" / ".f").write_text("x")
    monkeypatch.setattr(type(spark), "read", property(lambda self: (_ for _ in ()).throw(AssertionError("no scan is planned"))))
    assert fs.folder_is_empty(spark, str(tmp_path / "deep")) is False
    assert fs.folder_is_empty(spark, str(tmp_path / "hidden")) is True
    monkeypatch.undo()
    counts = {r.folder: r.n_files for r in fs.file_counts(spark, str(tmp_path)).collect()}
    assert len(counts) == 50 and set(counts.values()) == {1}
