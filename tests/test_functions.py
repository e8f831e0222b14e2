"""Column helpers and operators on small literal frames."""

from __future__ import annotations

import pytest
from conftest import RS, US
from pyspark.sql import functions as F

from feedlake.functions import header, manifest, paths, rows, text
from feedlake.functions.paths import Layout
from feedlake.operators import filters, joins, schema, sinks
from feedlake.operators.rows import route
from feedlake.sources import allowlists, catalog, framed


def one(spark, column, **values):
    """Value of a column over one row of string (or list) values."""
    frame = spark.range(1)
    for name, value in values.items():
        frame = frame.withColumn(name, F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value))
    return frame.select(column).first()[0]


# -- text ---------------------------------------------------------------------------------------


def test_clean_record(spark):
    assert one(spark, text.clean_record(F.col("v")), v=f"\na\r\nb{RS}\rc") == "a b c"


@pytest.mark.parametrize("value,blank", [("", True), (" \t\r\n", True), (US * 3, True), (f"{US}0", False), ("\n1", False)])
def test_blank(spark, value, blank):
    assert one(spark, text.is_blank(F.col("v")), v=value) is blank


def test_a_closing_line_terminator_is_not_blank(spark):
    assert one(spark, text.is_blank(F.col("v")), v=" \u0085") is False


def test_normalise_title(spark):
    assert one(spark, text.normalise_title(F.col("v")), v="Allergy  Name") == "allergy__name"


def test_header_tokens(spark):
    titles = "Allergy ID,Type,Patient ID,Chart ID,CONTEXT_ID,CONTEXT_NAME,PARENT,Allergy, Name".split(",")
    assert len(titles) == 9
    assert one(spark, text.header_fields(F.col("v")), v="\n" + US.join(titles) + RS) == titles
    assert one(spark, text.header_fields(F.col("v")), v=f"a{US}{US}b, c{US}{US}") == ["a", "", "b, c"]


def test_rows_keep_trailing_empty_fields(spark):
    value = f"a{US}{US}"
    assert one(spark, text.split_fields(F.col("v")), v=value) == ["a", "", ""]
    assert one(spark, text.join_fields(text.split_fields(F.col("v"))), v=value) == value


def test_control_line(spark):
    line = "1111~2015-01-02~2015-01-03~JOB9~/user/feed/2015-01-01"
    assert one(spark, text.control_to_fields(F.col("v")), v=line + "\n") == line.replace("~", US)
    entry = one(spark, manifest.control_entry(F.col("v")), v=line)
    assert tuple(entry) == tuple(line.split("~"))
    assert one(spark, manifest.control_entry(F.col("v"), job_field=4), v=line)["job_id"].startswith("/user")
    assert one(spark, manifest.control_entry(F.col("v")), v="1111")["job_id"] == ""


# -- paths --------------------------------------------------------------------------------------


def test_path_parts(spark):
    path = "file:/land/data/1111/feed/finished/2015-09-01/allergy_4.0_1_1111.asv"
    layout = Layout()
    p = F.col("p")
    assert one(spark, layout.org_id(p), p=path) == "1111"
    assert one(spark, layout.feed_date(p), p=path) == "2015-09-01"
    assert one(spark, paths.directory(p), p=path) == path.rsplit("/", 1)[0] + "/"
    assert one(spark, paths.entity_of(paths.file_name(p)), p=path) == "allergy"
    moved = layout.for_practice(paths.directory(p), F.lit("22"))
    assert one(spark, moved, p=path) == "file:/land/data/22/feed/finished/2015-09-01/"
    assert layout.any_org("/land/data/1111/feed/finished/2015-09*") == "/land/data/*/feed/finished/2015-09*"
    assert layout.any_org("/land/data/*/feed") == "/land/data/*/feed"
    assert layout.any_org("/elsewhere") == "/elsewhere"
    hive = Layout("/data/org_id=", "/feed_date=")
    assert one(spark, hive.org_id(p), p="/x/data/org_id=7/feed_date=2015/f_1") == "7"
    assert one(spark, hive.feed_date(p), p="/x/data/org_id=7/feed_date=2015/f_1") == "2015"


@pytest.mark.parametrize(
    "path,kind",
    [
        ("/d/1/Manifest_1.asv", "manifest"),
        ("/d/manifest/x_1.asv", "manifest"),
        ("/d/1/control.txt", "control"),
        ("/d/1/allergy_1.asv", "data"),
        ("/d_1/1/notes", "unrecognised"),
    ],
)
def test_file_kind(spark, path, kind):
    assert one(spark, paths.file_kind(F.col("p")), p=path) == kind


def test_output_name(spark):
    name = paths.output_name(F.lit("allergy"), F.timestamp_millis(F.lit(1439391600123)))
    assert one(spark, name) == "allergy.1439391600123.txt"


# -- manifest -----------------------------------------------------------------------------------

GOOD = "transaction_4.0_20150812090417_1562.asv"


@pytest.mark.parametrize(
    "line,expected",
    [
        (f"\n{GOOD}{US}16{US}hash{US}08/12/2015 09:04:17{US}", (GOOD, "transaction", "1562", 16, "ok")),
        (f"{GOOD}{US}0{US}hash", (GOOD, "transaction", "1562", 0, "zero_rows")),
        (f"{GOOD}{US}-1", (GOOD, "transaction", "1562", -1, "zero_rows")),
        (f"allergy{US}111{US}x", ("", "", "", 111, "bad_name")),
        (f"plain.asv{US}111", ("plain.asv", "plain", "plain", 111, "bad_name")),
        (f"{GOOD}{US}many", (GOOD, "transaction", "1562", None, "bad_count")),
        (f"{GOOD}{US}99999999999", (GOOD, "transaction", "1562", 99999999999, "ok")),
        (f"{GOOD}{US}9{'0' * 19}", (GOOD, "transaction", "1562", None, "bad_count")),
        (f"{GOOD}{US}", (GOOD, "transaction", "1562", None, "single_field")),
    ],
)
def test_manifest_entry(spark, line, expected):
    assert tuple(one(spark, manifest.manifest_entry(F.col("v")), v=line)) == expected


# -- header and golden schema -------------------------------------------------------------------

FILE = "Allergy ID,Type,Patient ID,Chart ID,CONTEXT_ID,CONTEXT_NAME,CONTEXT_PARENTCONTEXTID,Allergy Name,Allergy Code".split(",")
ROW = "6574,DT,8928,32,24452,LADIDADI,DATSIK,Gatorade,520000".split(",")
GOLDEN = "context_id,context_name,context_parentcontextid,patient_id,chart_id,type,allergy_id,allergy_name,allergy_code".split(",")


def reordered(spark, names, golden, row):
    positions = header.golden_positions(header.normalise_all(F.col("n")), F.col("g"))
    no = F.transform(F.col("g"), lambda g: F.lit(False))
    moved = rows.to_golden_order(F.col("r"), rows.all_fields_pattern(F.col("n")), rows.golden_text(positions, no))
    return one(spark, moved, n=names, g=golden, r=US.join(row)).split(US)


def test_reorder(spark):
    assert reordered(spark, FILE, GOLDEN, ROW) == "24452,LADIDADI,DATSIK,8928,32,DT,6574,Gatorade,520000".split(",")


def test_reorder_with_unknown_title(spark):
    got = reordered(spark, ["Allergy ID", "Type", "Patient ID"], ["patient_id", "allergy_id", "tyep"], ["1", "T", "2"])
    assert got == ["2", "1", ""]


def test_reorder_repeated_title_takes_the_last(spark):
    assert reordered(spark, ["A", "B", "a"], ["a", "b"], ["1", "2", "3"]) == ["3", "2"]


def test_needs_reorder(spark):
    names = header.normalise_all(F.col("n"))
    titles = ["Allergy ID", "Type", "Patient ID", "Chart ID"]
    same, other = ["allergy_id", "type", "patient_id", "chart_id"], ["type", "allergy_id", "patient_id", "chart_id"]
    assert one(spark, header.needs_reorder(names, F.col("g")), n=titles, g=same) is False
    assert one(spark, header.needs_reorder(names, F.col("g")), n=titles, g=other) is True


@pytest.mark.parametrize("names,types,expected", [
    (["a", "b", "c"], ["X", "Y", "Z"], [("a", "X"), ("b", "Y"), ("c", "Z")]),
    (["a", "b", "c", "d"], ["X", "Y", "Z"], None),
    (["a", "b"], ["X", "Y", "Z"], [("a", "X"), ("b", "Y")]),
    (["a", "b", "a"], ["X", "Y", "Z"], [("b", "Y"), ("a", "Z")]),
])
def test_header_pairs(spark, names, types, expected):
    got = one(spark, header.header_pairs(F.col("n"), F.col("t")), n=names, t=types)
    assert (got and [tuple(p) for p in got]) == expected


def test_number_positions(spark):
    types = text.header_fields(F.lit(f"\nNUMBER{US}VARCHAR{US}number{US}NUMBERS"))
    assert one(spark, header.number_positions(types)) == [0, 2]


def blanked(spark, line, known, pii):
    k, p = F.col("k"), F.col("p")
    out = rows.blank_personal(F.col("r"), rows.source_pattern(k, p), rows.source_text(k))
    return one(spark, out, r=US.join(line), k=known, p=pii).split(US)


def test_personal_data(spark):
    line, pii = ["data", "data", "PIIDATA"], [False, False, True]
    assert blanked(spark, line, [True] * 3, pii) == ["data", "data", ""]
    assert blanked(spark, [*line, "beyond"], [False, True, True], pii) == ["data", ""]
    assert blanked(spark, line[:2], [True] * 3, pii) == ["data", "data"]
    assert blanked(spark, line, [True] * 3, [True, False, False]) == ["", "data", "PIIDATA"]
    assert blanked(spark, ["a$1\\", "", ""], [True] * 3, [False] * 3) == ["a$1\\", "", ""]
    assert blanked(spark, line, [False] * 3, [False] * 3) == [""]
    wide = [str(i) for i in range(150)]
    assert blanked(spark, wide, [True] * 150, [i == 120 for i in range(150)]) == wide[:120] + [""] + wide[121:]


    flags = catalog.has_personal_data(
        spark.createDataFrame(
            [("a", 1, "x", "Remove"), ("a", 2, "y", None), ("b", 1, "x", "removed")],
            "entity string, column_id long, column_name string, comment string",
        )
    )
    assert {r["entity"]: r["has_pii"] for r in flags.collect()} == {"a": True, "b": False}


@pytest.mark.parametrize("value", ["", "22", " 12 ", "+5", "-7", "1.", ".5", "1.0d", "1.5f", "1.0e3", " 1.5 ", "9223372036854775807", "-9223372036854775808", "0" * 30 + "7", "0" * 40, "9223372036854775799", "0x1.0p3", "-.5e-3F"])
def test_numbers_accepted(spark, value):
    assert one(spark, rows.is_number_text(F.col("v")), v=value) is True


@pytest.mark.parametrize("value", ["1e5", "12L", "NaN", ".", " ", "x", "1.2.3", "9223372036854775808", "-9223372036854775809", "9999999999999999999", "12345678901234567890", "1,000", "--1", "1.e", "0x1.0", "+", "1 2"])
def test_numbers_rejected(spark, value):
    assert one(spark, rows.is_number_text(F.col("v")), v=value) is False


def test_number_row(spark):
    line = US.join(["2222222222", "22", "Hey"])
    for positions, expected in (([0, 1], True), ([2], False), ([0, 2], False), ([9], True)):
        pattern = rows.numbers_pattern(F.array(*map(F.lit, "abc")), F.array(*map(F.lit, positions)))
        assert one(spark, rows.numbers_ok(F.col("r"), pattern), r=line) is expected
    none = rows.numbers_pattern(F.array(F.lit("a")), F.array().cast("array<int>"))
    assert one(spark, rows.numbers_ok(F.col("r"), none), r="x") is True


@pytest.mark.parametrize("names,types,golden,verdict", [
    (["CONTEXT_ID", "CONTEXT_NAME", "Onset Date"], None, ["context_id", "context_name", "onset_date"], "ok"),
    (["CONTEXT_ID", "CONTEXT_NAME", "Onset Date"], None, ["context_id", "context_name", "onset_date", "more"], "schema_mismatch"),
    (["CONTEXT_ID", "CONTEXT_NAME", "Onset Date"], None, ["context_id", "context_name"], "ok"),
    (["a", "A", "b"], None, ["a", "b", "c"], "schema_mismatch"),
    (["a", "b, c"], None, ["a", "b,_c"], "ok"),
    (["a", "b"], ["X"], ["a", "b"], "bad_header"),
    (["a", "b"], None, None, "no_golden_schema"),
])
def test_schema_match(spark, names, types, golden, verdict):
    frame = spark.createDataFrame(
        [(US.join(names), US.join(types or ["X"] * len(names)), golden, golden and [False] * len(golden))],
        "titles string, types string, golden array<string>, golden_pii array<boolean>",
    )
    assert schema.resolve_layout(frame).first()["file_verdict"] == verdict


def layout_of(spark, titles, types, golden, pii):
    frame = spark.createDataFrame(
        [(US.join(titles), US.join(types), golden, pii)],
        "titles string, types string, golden array<string>, golden_pii array<boolean>",
    )
    return schema.resolve_layout(frame)


def routed(spark, layout, values, **kw):
    records = spark.createDataFrame([(v,) for v in values], "value string").join(layout)
    return [(r["verdict"], r["line"].split(US)) for r in route(records, **kw).collect()]


def test_extra_column_with_personal_data(spark):
    layout = layout_of(spark, ["id", "ssn", "new"], ["NUMBER", "NUMBER", "X"], ["ssn", "id"], [True, False])
    values = [f"1{US}abc{US}n", f"1{US}2", f"1{US}2{US}n{US}beyond", f"x{US}2{US}n", US * 2]
    assert routed(spark, layout, values, validate=True) == [
        ("ok", ["", "1"]),
        ("bad_arity", ["1", ""]),
        ("bad_arity", ["1", ""]),
        ("bad_number", ["x", ""]),
    ]
    assert routed(spark, layout, values[:1], pii_extra_columns="reject") == [("bad_arity", ["1", ""])]


def test_header_with_trailing_empty_title(spark):
    layout = layout_of(spark, ["a", "b", ""], ["X", "X"], ["a", "b"], [False, False])
    assert routed(spark, layout, [f"1{US}2", f"1{US}2{US}"]) == [("ok", ["1", "2"]), ("bad_arity", ["1", "2", ""])]


# -- catalog ------------------------------------------------------------------------------------


def test_golden_schema(spark, monkeypatch):
    columns = spark.createDataFrame(
        [
            ("db", "allergy", "Allergy Name", "10", None),
            ("db", "allergy", "Patient ID", "2", "remove"),
            ("db", "allergy", "Loaded", "1", "ETL"),
            ("db", "allergy", "Skipped", "3", "Ignore"),
            ("db", "allergy", "", "4", None),
            ("db", "allergy", None, "5", None),
            ("db", "Mixed", "A", "1", None),
            ("other", "allergy", "B", "1", None),
            ("db", "allergy", "patient id", "300000", None),
        ],
        "databasename string, tablename string, columntitle string, columnid string, commentstring string",
    )
    golden = catalog.golden_schema(columns, "db")
    monkeypatch.setattr(catalog, "_ID_RANGE", 4)
    ordered = sorted((r["ordinal"], r["column_name"]) for r in catalog.with_ordinal(golden).collect())
    assert ordered == [(0, "patient_id"), (1, "allergy_name"), (2, "patient_id")]
    row = catalog.golden_by_entity(golden).first()
    assert (row["entity"], row["golden"], row["golden_pii"]) == ("allergy", ["patient_id", "allergy_name"], [True, False])


def test_column_counts(spark):
    columns = spark.createDataFrame(
        [("d", "a", None), ("d", "a", "x"), ("d", "a", "ETL"), ("d", "b", "Ignore"), ("d", "c", "")],
        "databasename string, tablename string, commentstring string",
    )
    tables = spark.createDataFrame(
        [("d", "a", None), ("d", "b", None), ("d", "c", "Ignore"), ("e", "a", None)],
        "databasename string, tablename string, commentstring string",
    )
    assert [tuple(r) for r in catalog.column_counts(columns, tables, "D").collect()] == [("A", 2)]


def test_jdbc_options(monkeypatch):
    monkeypatch.delenv("FEEDLAKE_JDBC_PASSWORD", raising=False)
    assert catalog.jdbc_options("jdbc:x", "me", "d.D") == {"url": "jdbc:x", "user": "me", "driver": "d.D"}
    monkeypatch.setenv("FEEDLAKE_JDBC_PASSWORD", "p")
    assert catalog.jdbc_options("jdbc:x") == {"url": "jdbc:x", "password": "p"}


def test_warehouse_table(spark):
    sinks.load_warehouse(spark.range(3), "feedlake_loaded")
    sinks.load_warehouse(spark.range(2), "feedlake_loaded")
    got = catalog.warehouse_query(spark, "SELECT count(*) AS n FROM feedlake_loaded").first()["n"]
    spark.sql("DROP TABLE feedlake_loaded")
    assert got == 5


# -- lists and joins ----------------------------------------------------------------------------


def test_allow_lists(spark, tmp_path):
    (tmp_path / "p").write_text('ab1~Name, "quoted"\nab1~Again\n7~x\n\n')
    (tmp_path / "d").write_text("Ab1~x\n9\n")
    (tmp_path / "e").write_text("allergy\nMANIFEST\n")
    read = lambda df: sorted(r[0] for r in df.collect())
    assert read(allowlists.practices(spark, str(tmp_path / "p"))) == ["7", "AB1"]
    assert read(allowlists.divisions(spark, str(tmp_path / "d"))) == ["9", "Ab1"]
    assert read(allowlists.entities(spark, str(tmp_path / "e"))) == ["ALLERGY", "MANIFEST"]


def test_facility_route(spark):
    facilities = spark.createDataFrame([("9999",), ("2208",), ("416",)], "facility string").withColumn("src", F.lit("/d/*/x"))
    divisions = spark.createDataFrame([("2208",), ("2208",)], "org_id string")
    got = filters.facility_route(facilities, F.col("facility"), F.col("src"), divisions)
    assert {r["facility"]: (r["run_type"], r["run_source"]) for r in got.collect()} == {
        "9999": ("all", "/d/*/x"),
        "2208": ("divisional", "/d/2208/x"),
        "416": ("path", "/d/416/x"),
    }


def test_unused_controls(spark):
    controls = spark.createDataFrame([("*",), ("1111",), ("1122",), ("11",)], "org_id string")
    manifests = spark.createDataFrame([("/data/1111/feed/M",), ("/data/*/feed/M",)], "file_path string")
    ids = manifests.withColumn("org_id", Layout().org_id(F.col("file_path")))
    read = lambda df: sorted(r["org_id"] for r in df.collect())
    assert read(joins.controls_with_manifest(controls, ids)) == ["*", "1111"]
    assert read(joins.controls_contained_in_manifest(controls, manifests)) == ["*", "11", "1111"]


def test_file_of_less_than_four_records(spark, landing):
    landing.put("1", "2015-09-01", "allergy_1.asv", f"a{US}b{RS}\nX{US}Y{RS}\n")
    small = framed.small_files(spark, [str(landing.root / "data")], F.lit(True))
    row = framed.with_header(small).first()
    assert (row["titles"], row["types"].strip(), row["body"]) == (f"a{US}b", f"X{US}Y", None)
    files = framed.inventory(spark, [str(landing.root / "data")])
    assert framed.data_records(spark, [str(landing.root / "data")], F.lit(True), files).count() == 0
    assert framed.small_files(spark, [str(landing.root / "none*")], F.lit(True)) is None


def test_first_head_records(spark, tmp_path):
    import pandas as pd

    good, short = tmp_path / "a b_1.asv", tmp_path / "s_1.asv"
    good.write_text(f"t{US}u{RS}\nX{US}Y{RS}\nrest")
    short.write_text("no separator")
    read = framed.head_reader(chunk=3)
    paths_ = [good.as_uri(), str(good), short.as_uri(), "nosuch://host/file"]
    got = next(iter(read([pd.DataFrame({"file_path": paths_})])))
    assert list(got["titles"]) == [f"t{US}u", f"t{US}u", None, None]
    assert got["types"][0] == f"\nX{US}Y"
