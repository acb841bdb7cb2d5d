from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest

from wattframe import fixed_values as fixed
from wattframe.sources import first_per_station, read_sessions, read_stations

HEADERS = [header for header, _, _ in fixed.SESSION_COLUMNS]
GOOD = {
    "User ID": "U1",
    "Vehicle Model": "Model A",
    "Battery Capacity (kWh)": "62,5",
    "Charging Station ID": "S1",
    "Charging Start Time": "01/02/24 03:05",
    "Charging End Time": "01/02/24 04:35",
    "Energy Consumed (kWh)": "12,345",
    "Charging Duration (hours)": "1,5",
    "Charging Rate (kW)": "8.2",
    "Charging Cost (EUR)": "3",
    "Time of Day": "Night",
    "Day of Week": "Thursday",
    "State of Charge (Start %)": "20",
    "State of Charge (End %)": "80",
    "Distance Driven (since last charge) (km)": "",
    "Temperature (C)": "-3,5",
    "Vehicle Age (years)": "2",
}


def _line(headers=HEADERS, **changes):
    return ";".join({**GOOD, **changes}[h] for h in headers)


def _file(path, lines, headers=HEADERS, bom=True, pad=" "):
    text = ";".join(f"{pad}{h}{pad}" for h in headers) + "\n" + "\n".join(lines) + "\n"
    path.write_text(text, encoding="utf-8-sig" if bom else "utf-8")
    return str(path)


def _one(spark, tmp_path, line):
    parsed = read_sessions(spark, _file(tmp_path / "s.csv", [line]))
    loaded, rejects = parsed.loaded.collect(), parsed.rejects.collect()
    assert len(loaded) + len(rejects) == 1
    return (loaded[0].asDict() if loaded else None), (rejects[0]["reject_reason"] if rejects else None)


def test_good_row_is_typed(spark, tmp_path):
    row, reason = _one(spark, tmp_path, _line())
    assert reason is None
    assert row["user_id"] == "U1"
    assert row["battery_capacity_kwh"] == Decimal("62.50")
    assert row["charging_start_time"] == datetime(2024, 2, 1, 3, 5)
    assert row["charging_end_time"] == datetime(2024, 2, 1, 4, 35)
    assert row["energy_consumed_kwh"] == Decimal("12.35")
    assert row["charging_rate_kw"] == Decimal("8.20")
    assert row["distance_driven_km"] is None
    assert row["temperature_c"] == Decimal("-3.50")
    assert row["vehicle_age_years"] == 2


@pytest.mark.parametrize(
    "text,expected",
    [
        ("1/2/24 3:05", datetime(2024, 2, 1, 3, 5)),
        ("31/12/68 0:00", datetime(2068, 12, 31)),
        ("31/12/69 0:00", datetime(1969, 12, 31)),
        ("31/12/99 23:59", datetime(1999, 12, 31, 23, 59)),
        ("29/02/24 10:00", datetime(2024, 2, 29, 10, 0)),
        # an hour that clocks skip in many places is kept as written
        ("31/03/24 01:30", datetime(2024, 3, 31, 1, 30)),
    ],
)
def test_times(spark, tmp_path, text, expected):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Lisbon")
    try:
        row, _ = _one(spark, tmp_path, _line(**{"Charging Start Time": text}))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["charging_start_time"] == expected


@pytest.mark.parametrize(
    "field,text,reason",
    [
        ("Charging Start Time", "bad", "bad time: charging_start_time"),
        ("Charging Start Time", "", "bad time: charging_start_time"),
        ("Charging Start Time", "01/02/2024 03:05", "bad time: charging_start_time"),
        ("Charging Start Time", "01-02-24 03:05", "bad time: charging_start_time"),
        ("Charging End Time", "30/02/24 10:00", "bad time: charging_end_time"),
        ("Charging End Time", "01/02/24 24:00", "bad time: charging_end_time"),
        ("Charging End Time", "01/02/24 10:61", "bad time: charging_end_time"),
        ("Charging Cost (EUR)", "1.234,5", "bad number: charging_cost_eur"),
        ("Charging Cost (EUR)", "free", "bad number: charging_cost_eur"),
        ("Battery Capacity (kWh)", "1234,5", "bad number: battery_capacity_kwh"),
        ("Vehicle Age (years)", "99999999999", "out of range: vehicle_age_years"),
        ("User ID", "x" * 51, "too long: user_id"),
        ("Time of Day", "x" * 21, "too long: time_of_day"),
    ],
)
def test_refused_values(spark, tmp_path, field, text, reason):
    assert _one(spark, tmp_path, _line(**{field: text})) == (None, reason)


@pytest.mark.parametrize(
    "field,text,name,expected",
    [
        ("Vehicle Age (years)", "3,0", "vehicle_age_years", None),
        ("Vehicle Age (years)", "", "vehicle_age_years", None),
        ("User ID", "", "user_id", ""),
        ("Vehicle Model", "  ", "vehicle_model", ""),
        ("Charging Station ID", "", "charging_station_id", ""),
        ("Time of Day", "", "time_of_day", None),
        ("Day of Week", " ", "day_of_week", None),
        ("Vehicle Model", '"a;b"', "vehicle_model", "a;b"),
        ("Vehicle Model", '"say ""hi"""', "vehicle_model", 'say "hi"'),
        ("Vehicle Model", '"  padded  "', "vehicle_model", "padded"),
        ("Vehicle Model", "Citroën ë-C4", "vehicle_model", "Citroën ë-C4"),
        ("Charging Cost (EUR)", " 7,1 ", "charging_cost_eur", Decimal("7.10")),
        ("Charging Cost (EUR)", "0,005", "charging_cost_eur", Decimal("0.01")),
    ],
)
def test_kept_values(spark, tmp_path, field, text, name, expected):
    row, reason = _one(spark, tmp_path, _line(**{field: text}))
    assert reason is None
    assert row[name] == expected


def test_line_shapes(spark, tmp_path):
    full = _line()
    lines = [
        full,
        full + ";surplus",
        full + ";",
        _line(**{"Vehicle Model": '"q;q"'}) + ";surplus",
        "",
        ";".join(full.split(";")[:6]),
        ";".join(full.split(";")[:5]),
        "   ",
    ]
    parsed = read_sessions(spark, _file(tmp_path / "s.csv", lines))
    reasons = {r["reject_reason"]: r["lines"] for r in parsed.counts().collect()}
    assert reasons == {None: 2, "too many fields": 3, "bad time: charging_end_time": 1}
    short = [r for r in parsed.loaded.collect() if r["energy_consumed_kwh"] is None]
    assert len(short) == 1
    assert short[0]["charging_end_time"] == datetime(2024, 2, 1, 4, 35)
    assert short[0]["day_of_week"] is None
    assert parsed.rejects.count() == 4


def test_short_line_has_no_trailing_names(spark, tmp_path):
    headers = [h for h in HEADERS if h != "User ID"] + ["User ID"]
    lines = [_line(headers, **{"User ID": ""}), ";".join(_line(headers).split(";")[:-1])]
    rows = read_sessions(spark, _file(tmp_path / "s.csv", lines, headers)).loaded.collect()
    assert sorted((r["user_id"] for r in rows), key=repr) == ["", None]


def test_columns_are_found_by_name(spark, tmp_path):
    headers = list(reversed(HEADERS)) + ["Remark"]
    line = ";".join({**GOOD, "Remark": "x"}[h] for h in headers)
    parsed = read_sessions(spark, _file(tmp_path / "s.csv", [line, line + ";surplus"], headers))
    rows = parsed.loaded.collect()
    assert [(r["user_id"], r["vehicle_age_years"]) for r in rows] == [("U1", 2)]
    # few columns asked for, same verdict on each line
    assert parsed.loaded.select("user_id").count() == 1
    assert parsed.rejects.select("reject_reason").collect() == [("too many fields",)]


def test_files_with_different_headers_are_not_mixed_up(spark, tmp_path):
    turned = list(reversed(HEADERS))
    paths = [_file(tmp_path / "a.csv", [_line()]), _file(tmp_path / "b.csv", [_line(turned)], turned)]
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_sessions(spark, paths).loaded.collect()
    same = [_file(tmp_path / "c.csv", [_line()], bom=False, pad="")]
    assert read_sessions(spark, paths[:1] + same).loaded.count() == 2


def test_file_without_a_header(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no header line"):
        read_sessions(spark, str(tmp_path / "empty.csv"))


def test_missing_column_refuses_every_line(spark, tmp_path):
    headers = [h for h in HEADERS if h != "Temperature (C)"]
    parsed = read_sessions(spark, _file(tmp_path / "s.csv", [_line(headers)] * 3, headers))
    assert parsed.loaded.count() == 0
    assert parsed.counts().collect() == [("missing column: Temperature (C)", 3)]


def test_line_break_inside_quotes(spark, tmp_path):
    path = _file(tmp_path / "s.csv", [_line(**{"Vehicle Model": '"a\nb"'}), _line()])
    rows = read_sessions(spark, path, multiline=True).loaded.collect()
    assert sorted(r["vehicle_model"] for r in rows) == ["Model A", "a\nb"]


def test_file_without_bom_and_padding(spark, tmp_path):
    assert read_sessions(spark, _file(tmp_path / "s.csv", [_line()], bom=False, pad="")).loaded.count() == 1


def test_header_only(spark, tmp_path):
    parsed = read_sessions(spark, _file(tmp_path / "s.csv", []))
    assert parsed.loaded.count() == 0
    assert parsed.rejects.count() == 0


# --- stations ---------------------------------------------------------------------------

STATION_HEADERS = [header for header, _, _ in fixed.STATION_COLUMNS]
STATION = ["S1", "Évora", "Évora", "Sé", "38,5714", "-7,9135", "22,2", "4"]


def _stations(spark, path, *rows):
    lines = [";".join(row) for row in rows]
    return read_stations(spark, _file(path, lines, STATION_HEADERS))


def _changed(**changes):
    names = [name for _, name, _ in fixed.STATION_COLUMNS]
    return [changes.get(name, value) for name, value in zip(names, STATION)]


def test_station_row(spark, tmp_path):
    row = _stations(spark, tmp_path / "a.csv", STATION).loaded.first()
    assert row["distrito"] == "Évora"
    assert row["latitude"] == Decimal("38.5714000")
    assert row["potencia_maxima_kw"] == Decimal("22.20")
    assert row["pontos_ligacao"] == 4
    assert row["warnings"] == []


def test_bad_station_values_are_kept_as_warnings(spark, tmp_path):
    row = _stations(
        spark,
        tmp_path / "a.csv",
        _changed(latitude="1.234,5", pontos_ligacao="two", potencia_maxima_kw="12345678", concelho="x" * 101),
    ).loaded.first()
    assert row["latitude"] is None
    assert row["potencia_maxima_kw"] is None
    assert row["pontos_ligacao"] is None
    assert row["concelho"] == "x" * 100
    assert row["warnings"] == ["cut: concelho", "bad number: latitude", "bad number: potencia_maxima_kw"]


def test_first_row_of_a_station_wins(spark, tmp_path):
    rows = [_changed(pontos_ligacao=str(n)) for n in (7, 1, 9)]
    parsed = _stations(spark, tmp_path / "b.csv", *rows, _changed(station_id="S2"))
    kept = {r["station_id"]: r["pontos_ligacao"] for r in first_per_station(parsed.loaded).collect()}
    assert kept == {"S1": 7, "S2": 4}


def test_first_row_across_files_and_blocks(spark, tmp_path):
    many = [_changed(station_id=f"S{i % 500}", pontos_ligacao=str(i)) for i in range(20000)]
    folder = tmp_path / "parts"
    folder.mkdir()
    _file(folder / "1.csv", [";".join(r) for r in many], STATION_HEADERS)
    _file(folder / "2.csv", [";".join(_changed(station_id=f"S{i}", pontos_ligacao="-1")) for i in range(600)], STATION_HEADERS)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        loaded = read_stations(spark, str(folder)).loaded
        assert loaded.rdd.getNumPartitions() > 4
        kept = {r["station_id"]: r["pontos_ligacao"] for r in first_per_station(loaded).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert kept == {f"S{i}": i if i < 500 else -1 for i in range(600)}


def test_surplus_field_refuses_a_station(spark, tmp_path):
    parsed = _stations(spark, tmp_path / "a.csv", STATION + ["x"], STATION)
    assert {r["reject_reason"]: r["lines"] for r in parsed.counts().collect()} == {None: 1, "too many fields": 1}


def test_values_are_computed_once(spark, tmp_path):
    """Also where the order of the lines is dropped: no condition on the values moves below them and repeats them."""
    parsed = read_sessions(spark, _file(tmp_path / "s.csv", [_line(), _line(**{"Charging End Time": "soon"})]))
    loaded = parsed.loaded.drop("_order")
    plan = loaded._jdf.queryExecution().optimizedPlan().toString()
    times = sum(kind == "timestamp_ntz" for _, _, kind in fixed.SESSION_COLUMNS)
    assert plan.count("regexp_replace") == times + 1  # and one that counts fields
    assert loaded.count() == 1


def test_rejects_of_a_load_look_for_its_reasons_only(spark, tmp_path):
    """Refused for the first of several problems as before, but values that no counted reason needs aren't parsed."""
    odd = [{"Charging Cost (EUR)": "x"}, {"Charging Cost (EUR)": "x", "Vehicle Age (years)": "99999999999"}]
    parsed = read_sessions(spark, _file(tmp_path / "s.csv", [_line(), *(_line(**changes) for changes in odd)]))
    counts = {row["reject_reason"]: row["lines"] for row in parsed.counts().collect()}
    assert counts.pop(None) == 1 and counts == {"bad number: charging_cost_eur": 2}
    after = replace(parsed, refused=counts).rejects
    assert sorted(map(str, after.collect())) == sorted(map(str, parsed.rejects.collect()))
    plan = after._jdf.queryExecution().optimizedPlan().toString()
    assert "AS charging_cost_eur" in plan and "AS charging_start_time" not in plan
