import csv
import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay import session
from loadbay.plans import anonymise, dashboard, explore, prepare
from loadbay.sources import prepared, raw


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)
    return str(path)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("raw")
    heads = list(S.PRODUCT_HEADERS)
    blank = {h: "" for h in heads}

    def row(head, **kw):
        names = {v: k for k, v in S.PRODUCT_HEADERS.items()}
        filled = {**blank, **{names[k]: v for k, v in kw.items()}}
        return [filled.get(h, "") for h in head]

    a_head = heads + ["SUKL 3000A-1 "]
    b_head = heads[:-1] + ["SUKL B", "SUKL C", "Extra"]
    a = [row(a_head, start_time=f"2024-01-0{1 + i % 3} 08:00:00", end_time="2024-01-09 08:00:10",
             process="100 - In", worker=f"Worker {i % 4}", quantity_pcs="3.9", duration_sec=str(i))
         for i in range(12)]
    b = [row(b_head, start_time="bad", process="200 - Out, \"quoted\"", worker="SYSTEM")] * 2
    w_head = list(S.WORKER_HEADERS)
    w = []
    for i in range(10):
        r = dict.fromkeys(w_head, "")
        r.update({"Employee ID": f"ID{i % 2}", "Employee Name": f"Worker {i % 2}", "Equipment": f"FAID{i % 2}",
                  "Prompt Date": f"2024-01-01 08:00:0{i % 9}", "Input Date": f"2024-01-01 0{i % 9}:10:00.250001",
                  "Dialog Type": "scan", "Screen Heading": f"Hello Worker {i % 2}"})
        w.append([r[h] for h in w_head])
    return ([write_csv(d / "first file.csv", a_head, a), write_csv(d / "second.csv", b_head, b)],
            [write_csv(d / "inputs.csv", w_head, w + w[:1])])


def test_raw_files_are_labelled_tagged_and_stacked(spark, files):
    df = raw.load_product_files(spark, files[0])
    assert df.columns == [*S.PRODUCT_RAW, "Extra"]
    assert {(r.source_file, r.product_label, r.row_count) for r in
            df.groupBy("source_file", "product_label").count()
              .withColumnRenamed("count", "row_count").collect()} == {
        ("first file.csv", "3000A-1", 12), ("second.csv", "B", 2)}
    second = df.where("source_file = 'second.csv'").first()
    assert second.target_mlp is None and second.process == '200 - Out, "quoted"'
    assert {r.source_file: r.row_count for r in raw.source_file_counts(df).collect()} == {
        "first file.csv": 12, "second.csv": 2}


def test_raw_tables_from_other_formats(spark, files, tmp_path):
    src = raw.read_text_table(spark, files[1][0])
    for fmt in ("json", "orc", "parquet"):
        path = str(tmp_path / fmt)
        src.write.format(fmt).save(path)
        df = raw.load_worker_files(spark, [path], fmt)
        assert df.count() == 11 and set(t for _, t in df.dtypes) == {"string"}
        assert df.select("source_file").first()[0] == fmt
    globbed = raw.load_worker_files(spark, [str(tmp_path / "parquet" / "*.parquet")], "parquet")
    assert globbed.select("source_file").first()[0].endswith(".parquet")


def test_folder_files_keep_their_own_header_label_and_name(spark, tmp_path):
    names = {v: k for k, v in S.PRODUCT_HEADERS.items()}
    heads = [names["worker"], names["process"], names["quantity_pcs"], names["start_time"], names["expiration"]]
    folder = tmp_path / "in"
    folder.mkdir()
    write_csv(folder / "one.csv", [*heads, "SUKL A"], [["Ann", "line one\nline two", "1", "31/1/2024 08:00", "2024-05-01", ""]])
    write_csv(folder / "two.csv", [*heads[::-1], "SUKL B"], [["2025-06-01", "1/2/2024 09:00", "2", "p", "Bo", ""]])
    for path in (str(folder), str(folder / "*.csv")):
        df = raw.load_product_files(spark, [path])
        got = {r.source_file: (r.worker, r.process, r.quantity_pcs, r.product_label) for r in df.collect()}
        assert got == {"one.csv": ("Ann", "line one\nline two", "1", "A"), "two.csv": ("Bo", "p", "2", "B")}
    from loadbay.operators import clean
    typed = clean.type_products(df, {"start_time": "d/M/yyyy HH:mm"}).orderBy("worker").collect()
    assert [(str(r.start_time), str(r.expiration)) for r in typed] == [
        ("2024-01-31 08:00:00", "2024-05-01 00:00:00"), ("2024-02-01 09:00:00", "2025-06-01 00:00:00")]


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    out = action()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, jobs


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_jobs_do_not_grow_with_files(spark, tmp_path, fmt):
    counts = {}
    for n in (40, 200):
        folder = tmp_path / f"{fmt}{n}"
        folder.mkdir()
        for i in range(n):
            name = folder / f"f{i:03d}.{fmt}"
            if fmt == "csv":
                write_csv(name, ["Employee ID", "Dialog Type"][:1 + i % 2], [[f"E{i}", "x"][:1 + i % 2]])
            elif fmt == "json":
                name.write_text('{"Employee ID": "E%d"%s}\n' % (i, ', "Dialog Type": "x"' if i % 2 else ""))
            else:
                import pandas as pd
                pd.DataFrame({"Employee ID": [f"E{i}"], **({"Dialog Type": ["x"]} if i % 2 else {})}).to_parquet(name)
        df, counts[n] = jobs_of(spark, f"{fmt}-{n}", lambda: raw.load_worker_files(spark, [str(folder)], fmt))
        rows = df.select("employee_id", "dialog_type", "source_file").collect()
        assert sorted((r[0], r[1], r[2]) for r in rows) == sorted(
            (f"E{i}", "x" if i % 2 else None, f"f{i:03d}.{fmt}") for i in range(n))
    assert counts[200] <= counts[40] <= 12


def test_headers_with_quoted_line_breaks_are_compared_whole(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, last in (("a", "SUKL A"), ("b", "SUKL B"), ("c", "SUKL A")):
        (tmp_path / "in" / f"{name} x.csv").write_text(f'"Extra\nline ""q"" 1","{last}"\nv{name},\n', encoding="utf-8")
    (tmp_path / "in" / "empty.csv").write_text("")
    got = raw.exports(spark, str(tmp_path / "in"), "csv")
    assert [x[2] for x in got] == ['"Extra\nline ""q"" 1","SUKL A"', '"Extra\nline ""q"" 1","SUKL B"', '"Extra\nline ""q"" 1","SUKL A"']
    df = raw.load_product_files(spark, [str(tmp_path / "in")])
    assert {(r["source_file"], r["product_label"], r['Extra\nline "q" 1']) for r in df.collect()} == {
        ("a x.csv", "A", "va"), ("b x.csv", "B", "vb"), ("c x.csv", "A", "vc")}


def test_cached_tables_are_read_once_until_reloaded(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("E1",)], "employee_id string").write.parquet(path)
    first = prepared.cached(spark, path, "workers")
    assert first is prepared.cached(spark, path, "workers") and first.is_cached and first.count() == 1
    spark.createDataFrame([("E2",)], "employee_id string").write.mode("append").parquet(path)
    again = prepared.cached(spark, path, "workers", reload=True)
    assert again.count() == 2
    again.unpersist()


def test_prepared_csv_keeps_line_breaks(spark, tmp_path):
    path = str(tmp_path / "w")
    text = 'first "quoted"\nsecond'
    prepared.export_csv(spark.createDataFrame([("E1", text), ("E2", "x")], "employee_id string, screen_text string"), path)
    got = {r.employee_id: r.screen_text for r in prepared.load_workers(spark, path, "csv").collect()}
    assert got == {"E1": text, "E2": "x"}


def test_whole_pipeline(spark, files, tmp_path):
    out = str(tmp_path / "out")
    prepare.run(spark, *files, out)
    p, w = prepared.load_products(spark, f"{out}/products"), prepared.load_workers(spark, f"{out}/workers")
    assert (p.count(), w.count()) == (13, 10)  # equal rows of one file collapse
    assert [c for c in p.columns if c != "Extra"] == S.PREPARED_PRODUCTS.names
    assert w.columns == S.PREPARED_WORKERS.names
    assert p.where("quantity_pcs = 3").count() == 12
    plan = p.where("date = DATE'2024-01-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert w.agg({"input_date": "max"}).first()[0] == dt.datetime(2024, 1, 1, 8, 10, 0, 250001)

    anonymise.run(spark, out)
    a, b = prepared.load_products(spark, f"{out}/products"), prepared.load_workers(spark, f"{out}/workers")
    assert (a.count(), b.count()) == (13, 10)
    text = " ".join(map(str, a.collect())) + " ".join(map(str, b.collect()))
    assert "Worker" not in text and "ID0" not in text and "SYSTEM" in text
    shared = a.select("worker").intersect(b.select("employee_name")).count()
    assert shared == 2  # the same person has the same pseudonym in both tables


def test_csv_round_trip_keeps_values(spark, files, tmp_path):
    w = prepare.prepare_workers(raw.load_worker_files(spark, files[1]))
    path = str(tmp_path / "csv")
    prepared.write_prepared(w, path, "csv")
    back = prepared.load_workers(spark, path, "csv")
    assert back.dtypes == w.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, w.collect()))
    part = spark.read.csv(path, header=True).drop("session_id", "date")
    part.write.mode("overwrite").csv(str(tmp_path / "part"), header=True)
    assert len(prepared.load_workers(spark, str(tmp_path / "part"), "csv").columns) == 34


def test_replacing_a_table_that_is_being_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "DATE'2024-01-01' AS date").write.partitionBy("date").parquet(path)
    prepared.replace_table(spark.read.parquet(path).where("id < 4"), path, str(tmp_path / "s"))
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(ValueError):
        prepared.replace_table(spark.range(1), path, path + "/")


def rows_of(spark, out):
    return [sorted(map(str, load(spark, f"{out}/{name}").collect())) for load, name in
            ((prepared.load_products, "products"), (prepared.load_workers, "workers"))]


@pytest.mark.parametrize("step", ["workers", "pointer"])
def test_a_failure_between_the_tables_leaves_both_old(spark, files, tmp_path, monkeypatch, step):
    out = str(tmp_path / "out")
    prepare.run(spark, *files, out)
    before = rows_of(spark, out)
    write, name = prepared.write_prepared, "write_prepared" if step == "workers" else "_point"

    def failing(first, *args):
        if step == "pointer" or args[0].endswith("/workers"):
            raise OSError("lost")
        write(first, *args)
    with monkeypatch.context() as m:
        m.setattr(prepared, name, failing)
        with pytest.raises(OSError, match="lost"):
            anonymise.run(spark, out)
    assert rows_of(spark, out) == before
    assert len(list((tmp_path / "out" / prepared.VERSIONS).iterdir())) <= 1
    anonymise.run(spark, out)
    after = rows_of(spark, out)
    assert [len(x) for x in after] == [len(x) for x in before] and "Worker" not in str(after)
    # the original rows are gone, and only one version is left
    kept = [f for f in (tmp_path / "out").rglob("*.parquet")]
    assert kept and len({f.relative_to(tmp_path / "out").parts[1] for f in kept}) == 1
    assert not (tmp_path / "out" / "products").exists()


def test_publishing_one_table_leaves_the_others(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(3).selectExpr("id", "DATE'2024-01-01' AS date")
    prepared.publish(spark, root, {"a": rows, "b": rows})
    prepared.publish(spark, root, {"a": spark.read.parquet(prepared.located(spark, f"{root}/a")).where("id > 0")})
    count = lambda name: spark.read.parquet(prepared.located(spark, f"{root}/{name}")).count()
    assert (count("a"), count("b")) == (2, 3)
    prepared.publish(spark, root, {"b": rows.limit(1)}, keep_old=True)
    assert count("b") == 1 and len(list((tmp_path / prepared.VERSIONS).glob("*/b"))) == 2
    assert prepared.located(spark, f"{root}/c") == f"{root}/c"


def test_a_failed_replacement_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("id", "DATE'2024-01-01' AS date").write.partitionBy("date").parquet(path)
    rename = prepared._rename
    monkeypatch.setattr(prepared, "_rename", lambda s, a, b: not a.endswith("/s") and rename(s, a, b))
    with pytest.raises(OSError):
        prepared.replace_table(spark.read.parquet(path).where("id = 0"), path, str(tmp_path / "s"))
    assert spark.read.parquet(path).count() == 3


def test_reports_and_pages_run(spark, files, tmp_path):
    prepare.run(spark, *files, str(tmp_path))
    p = prepared.load_products(spark, str(tmp_path / "products"))
    w = prepared.load_workers(spark, str(tmp_path / "workers"))
    report = {**{f"p_{k}": v for k, v in explore.product_report(p).items()},
              **{f"w_{k}": v for k, v in explore.worker_report(w).items()}}
    assert len(report) == 38
    explore.write_report({k: report[k] for k in ("p_daily", "w_correlation")}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "p_daily")).count() == 3
    pages = [dashboard.overview(p, w), dashboard.operations(p), dashboard.operations(p, "weekly", "qty", False),
             dashboard.products(p), dashboard.workforce(p, w, worker="Worker 1"),
             dashboard.anomalies(p, w, dashboard.AnomalySettings("IQR", 2.0, 1.0)),
             dashboard.data_explorer(p, w)]
    for page in pages:
        for name, df in page.items():
            assert df.columns, name
    assert pages[0]["kpis"].first().operations == 13
    assert pages[4]["worker_kpis"].first().total_ops == 3
    for name in ("duration_histogram", "duration_top", "response_summary"):
        for page in pages:
            if name in page:
                page[name].collect()


def test_command_line_jobs(spark, files, tmp_path):
    from loadbay.__main__ import main
    out = str(tmp_path / "cli")
    main(["prepare", "--products", *files[0], "--workers", *files[1], "--out", out, "--format", "csv"])
    assert prepared.load_products(spark, f"{out}/products", "csv").count() == 13
    main(["anonymise", "--prepared", out, "--staging", str(tmp_path / "st"), "--format", "csv"])
    back = prepared.load_workers(spark, f"{out}/workers", "csv")
    assert back.count() == 10 and back.where("employee_name like 'Worker%'").count() == 0
    with pytest.raises(SystemExit):
        main(["nothing"])


def test_intermediate_tables_go_with_their_scope(spark):
    import os
    from loadbay.session import cut, fresh_path, scratch
    kept = cut(spark.range(3))
    with pytest.raises(KeyError), scratch(spark):
        inner = cut(spark.range(3))
        raise KeyError
    there = lambda df: os.path.exists(df._cut_path.removeprefix("file:"))
    assert there(kept) and not there(inner) and fresh_path(spark, "x") != fresh_path(spark, "x")


def test_prepared_csv_is_compressed_and_exports_are_plain(spark, tmp_path):
    df = spark.createDataFrame([("Ann", "a\nb")], "worker string, process string")
    prepared.write_prepared(df, f"{tmp_path}/stage", "csv")
    prepared.export_csv(df, f"{tmp_path}/export")
    assert {f.name[-7:] for f in (tmp_path / "stage").glob("part-*")} == {".csv.gz"}
    assert {f.name[-4:] for f in (tmp_path / "export").glob("part-*")} == {".csv"}
    back = prepared.load_products(spark, f"{tmp_path}/stage", "csv").select("worker", "process")
    assert [tuple(r) for r in back.collect()] == [("Ann", "a\nb")]


def test_staged_tables_leave_no_shuffle_files(spark, monkeypatch):
    """Also in slices, which take no more of the join's other side than their own keys and lose no row."""
    def shuffled():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = manager.getAllFiles()
        return {files.apply(i).getName() for i in range(files.length()) if "shuffle_" in files.apply(i).getName()}

    rows = spark.range(0, 5000, 1, 4).selectExpr("IF(id % 9 = 0, NULL, id % 50) day", "id % 7 who", "id")
    totals = rows.groupBy("day", "who").agg(F.count("*").alias("n"))
    want = sorted(map(repr, rows.join(totals, ["day", "who"], "left").collect()))
    for n in (session.SLICE_ROWS, 700):
        monkeypatch.setattr(session, "SLICE_ROWS", n)
        before = shuffled()
        out = session.stage(spark, f"slices_{n}", lambda: rows.join(totals, ["day", "who"], "left"), by="day",
                            rows=rows.count)
        begun = time.time()
        while shuffled() - before and time.time() - begun < 20:
            time.sleep(.2)
        assert not {f for f in shuffled() - before if f.endswith(".data")}
        assert sorted(map(repr, out.collect())) == want
        session.unstage(spark, f"slices_{n}")
        again = session.stage(spark, f"slices_{n}", lambda: rows.limit(1))
        assert again.count() == 1
        session.unstage(spark, f"slices_{n}")
