from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quillbank.sources import io
from quillbank.sources.store import ItemStore
from quillbank.streaming.ingest import ingest_stream

ROWS = "parte,tema,titulo,LEY,articulo,tipo,tema_no_juridico\ngeneral,1, La  Constitución ,Ley 1/2000,5,juridico,\nespecial,x,,,7,otra,\n"


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "cp1252"])
def test_syllabus(spark, tmp_path, encoding):
    (tmp_path / "s.csv").write_bytes(ROWS.encode(encoding))
    rows = io.read_syllabus_csv(spark, str(tmp_path / "s.csv"))
    first = rows.filter("tema = 1").first()
    assert (first["parte"], first["titulo"], first["tipo"]) == ("GENERAL", "La Constitución", "JURIDICO")
    assert {r["rule"] for r in io.validate_syllabus(rows).collect()} == {"TITLE", "TOPIC", "TYPE", "ARTICLE_WITHOUT_NORM"}


def test_each_file_has_its_own_encoding_and_header(spark, tmp_path):
    head = "parte,tema,titulo,LEY,articulo,tipo,tema_no_juridico\n"
    files = {
        "a.csv": (head + 'general,1,"Título «uno», y\n dos",L,,juridico,\n').encode(), "b.csv": ("\ufeff" + head + "g,2,Año,L,,otros,\n").encode(), "c.csv": (head + "g,3,“Año” €,L,,otros,\n").encode("cp1252"),
        "d.csv": (head + "g,4,Año \x81,L,,otros,\n").encode("latin-1"), "e.csv": b"titulo,sobra,tema\r\nX,1,5\r\n\r\nY,2\r\n", "f.csv": b"", "g.csv": head.encode(),
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = sorted((r["path"].rsplit("/", 1)[1], r["line"], r["encoding"], r["tema"], r["titulo"], r["parte"], r["LEY"]) for r in io.read_syllabus_csv(spark, str(tmp_path)).collect())
    assert got == [
        ("a.csv", 1, "utf-8", 1, "Título «uno», y dos", "GENERAL", "L"), ("b.csv", 1, "utf-8", 2, "Año", "G", "L"), ("c.csv", 1, "cp1252", 3, "“Año” €", "G", "L"), ("d.csv", 1, "latin-1", 4, "Año \x81", "G", "L"),
        ("e.csv", 1, "utf-8", 5, "X", "", ""), ("e.csv", 2, "utf-8", None, "Y", "", ""),
    ]


def test_order_of_references():
    assert io.load_order({"a": {"b"}, "b": {"c", "b"}, "c": set(), "d": set()}) == ["c", "d", "b", "a"]
    with pytest.raises(ValueError, match="cycle of references: b -> c -> b"):
        io.load_order({"a": {"b"}, "b": {"c"}, "c": {"b"}})
    with pytest.raises(ValueError, match="aren't published: z"):
        io.load_order({"a": {"z"}})


def test_tables_are_published_together_or_not_at_all(spark):
    url = "jdbc:derby:memory:together;create=true"
    norms = spark.createDataFrame([(1, "x"), (2, None)], "id long, name string")
    items = spark.createDataFrame([(10, 1, 1), (11, None, 0)], "id long, norm_id long, active int")
    refs = {"items": {"norm_id": ("norms", "id")}}
    read = lambda: (sorted(map(tuple, spark.read.jdbc(url, "norms").collect()), key=str), sorted(map(tuple, spark.read.jdbc(url, "items").collect()), key=str))
    assert io.publish_all({"items": items, "norms": norms}, refs, url, {"items": ("active",)}) == {"norms": 2, "items": 2}
    old = read()
    assert old == ([(1, "x"), (2, None)], [(10, 1, True), (11, None, False)])
    with pytest.raises(ValueError, match="1 rows of items refer by norm_id to nothing in norms"):
        io.publish_all({"items": items, "norms": norms.filter("id = 2")}, refs, url, {"items": ("active",)})
    assert read() == old
    # a failure inside of the transaction leaves all old rows
    with pytest.raises(Exception, match="(?i)other|column"):
        io.publish_all({"norms": norms.filter("id = 2"), "items": items.filter("id = 11").withColumn("other", F.lit(1))}, refs, url, {"items": ("active",)})
    assert read() == old
    io.publish_all({"items": items.filter("id = 11"), "norms": norms.filter("id = 2")}, refs, url, {"items": ("active",)})
    assert read() == ([(2, None)], [(11, None, False)])


def test_json_sources(spark, tmp_path):
    call = {"codigo": "C1", "posicion": 1, "activa": True, "numero_preguntas": 30, "puntuacion": {"acierto": 1.0, "error": -0.3, "blanco": 0.0}, "partes": [{"nombre": "GENERAL", "numero_preguntas": 10, "orden": 1}, {"nombre": "ESPECIAL", "numero_preguntas": 20, "orden": 2}]}
    (tmp_path / "c.json").write_text(json.dumps(call))
    (tmp_path / "m.json").write_text(json.dumps([{"pregunta_id": 1, "examen": "e", "numero": 2, "similitud": 0.9, "fuente": "f"}]))
    assert io.read_call_config(spark, str(tmp_path / "c.json")).agg(F.sum("numero_preguntas")).first()[0] == 30
    assert io.read_matches_json(spark, str(tmp_path / "m.json")).first()["similitud"] == 0.9


def test_reports_and_versions(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "id long, a string"), spark.createDataFrame([(2, "y")], "id long, b string")
    io.write_report([a, b], str(tmp_path / "r"), ";")
    assert spark.read.csv(str(tmp_path / "r"), header=True, sep=";").columns == ["id", "a", "b"]
    io.write_summary(spark.createDataFrame([("n", 3)], "name string, value long"), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).first()["metrics"]["n"] == 3
    assert spark.read.parquet(io.overwrite_table(a, str(tmp_path / "t"), {"none": a.filter("id > 5")})).count() == 1
    with pytest.raises(ValueError, match="some"):
        io.overwrite_table(a, str(tmp_path / "t"), {"some": a})


ITEM = "file string, file_hash string, row_id long, content_key string"


def _store(spark, tmp_path, name="store"):
    return ItemStore(spark, str(tmp_path / name), ITEM)


def _none(spark):
    return spark.createDataFrame([], "file string, file_hash string, error string"), spark.createDataFrame([], "row_id long")


def _rows(store):
    return sorted((r["file"], r["row_id"], r["content_key"]) for r in store.pool().collect())


def test_files_are_taken_once_replaced_and_refused(spark, tmp_path):
    store, (ok, free) = _store(spark, tmp_path), _none(spark)
    items = lambda *rows: spark.createDataFrame(list(rows), ITEM)
    first = items(("f", "h1", 1, "a"), ("f", "h1", 2, "b"), ("f", "h1", 3, "a"), ("g", "k1", 4, "b"), ("g", "k1", 5, "c"))
    assert store.commit("one", first, ok, free) and not store.commit("one", first, ok, free)
    assert _rows(store) == [("f", 1, "a"), ("f", 2, "b"), ("g", 5, "c")]
    assert {(r["file"], r["state"], r["inserted"], r["duplicates"]) for r in store.log().collect()} == {("f", "COMPLETED", 2, 1), ("g", "COMPLETED", 1, 1)}
    # known content, even under another name, changes nothing
    assert store.commit("two", items(("moved", "h1", 11, "z")), ok, free) and store.log().count() == 2 and _rows(store)[0] == ("f", 1, "a")
    # new content replaces the file's own rows: b is free for others, a comes again
    store.commit("three", items(("f", "h2", 21, "a"), ("f", "h2", 22, "c")), ok, free)
    assert _rows(store) == [("f", 21, "a"), ("g", 5, "c")]
    # a file that banks use isn't replaced, one that fails keeps its rows, and both are noted
    store.commit("four", items(("f", "h3", 31, "q")), spark.createDataFrame([("g", "k2", "page 2")], "file string, file_hash string, error string"), spark.createDataFrame([(21,)], "row_id long"))
    assert _rows(store) == [("f", 21, "a"), ("g", 5, "c")]
    assert {(r["file"], r["state"], r["error"]) for r in store.log().collect()} == {("f", "ERROR", "LINKED:1"), ("g", "ERROR", "page 2")}
    # after an error the same content is taken
    store.commit("five", items(("f", "h3", 31, "q")), ok, free)
    assert _rows(store) == [("f", 31, "q"), ("g", 5, "c")]
    assert store.commit("six", items(("f", "h3", 31, "q")), ok, free) and store.manifest()[0] == 6
    store.commit("seven", items(("f", "h3", 41, "q")), ok, free, force=True)
    assert _rows(store) == [("f", 41, "q"), ("g", 5, "c")]
    before = _rows(store), sorted(map(str, store.log().collect()))
    store.compact("all")
    assert (_rows(store), sorted(map(str, store.log().collect()))) == before and store.manifest()[1] == ["all"]


def test_a_batch_that_dies_is_not_seen_and_runs_again(spark, tmp_path, monkeypatch):
    store, (ok, free) = _store(spark, tmp_path), _none(spark)
    batch = spark.createDataFrame([("f", "h", 1, "a"), ("f", "h", 2, "b")], ITEM)
    with monkeypatch.context() as m:
        m.setattr(ItemStore, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            store.commit("one", batch, ok, free)
    assert store.manifest() == (0, []) and store.pool().count() == 0 == store.log().count()
    assert store.commit("one", batch, ok, free) and store.pool().count() == 2
    assert [(r["inserted"], r["duplicates"]) for r in store.log().collect()] == [(2, 0)]


def test_two_writers_of_one_version(spark, tmp_path):
    store = _store(spark, tmp_path)
    store._publish(1, ["a"])
    with pytest.raises(Exception, match="(?i)exist"):
        store._publish(1, ["b"])
    assert store.manifest() == (1, ["a"])


def test_stream_takes_each_file_once(spark, tmp_path):
    store, (_, free), src = _store(spark, tmp_path), _none(spark), str(tmp_path / "src")
    spark.createDataFrame([("f", "h", 1, "a"), ("f", "h", 2, "b"), ("f", "h", 3, "a")], ITEM).write.parquet(src)
    ingest_stream(store, src, str(tmp_path / "cp1"), free).awaitTermination(120)
    assert store.pool().count() == 2 and store.log().count() == 1
    ingest_stream(store, src, str(tmp_path / "cp1"), free).awaitTermination(120)
    ingest_stream(store, src, str(tmp_path / "cp2"), free, "other").awaitTermination(120)  # replay
    assert store.pool().count() == 2 and store.log().count() == 1
    spark.createDataFrame([("f", "h2", 7, "c"), ("g", "k", 8, "b")], ITEM).write.mode("append").parquet(src)
    ingest_stream(store, src, str(tmp_path / "cp1"), free).awaitTermination(120)
    assert _rows(store) == [("f", 7, "c"), ("g", 8, "b")]


def test_tables_by_name(spark):
    region, nation = io.read_tables(spark, "/root/testdata/sf0.001", "region", "nation")
    assert region.count() == 5 and nation.count() == 25 and "r_name" in region.columns


def test_page_texts(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo", encoding="utf-8")
    (tmp_path / "b.txt").write_text("", encoding="utf-8")
    got = {r["path"].rsplit("/", 1)[1]: r["text"] for r in io.read_page_texts(spark, str(tmp_path)).collect()}
    assert got.get("a.txt") == "one\ntwo" and not got.get("b.txt")


def test_published_rows_are_counted(spark, monkeypatch):
    url = "jdbc:derby:memory:published;create=true"
    df = spark.createDataFrame([(1, 0), (2, 1)], "id long, active int")
    for _ in range(2):  # the second time the table is there and reloaded
        io.publish_jdbc(df, url, "items", ("active",))
    assert sorted(map(tuple, spark.read.jdbc(url, "items").collect())) == [(1, False), (2, True)]
    monkeypatch.setattr(type(df), "count", lambda _, n=iter((3, 2)): next(n))
    with pytest.raises(ValueError, match="2 rows instead of 3"):
        io.publish_jdbc(df, url, "items", ("active",))
