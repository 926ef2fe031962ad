import pytest

from specweave.operators.units import converted

DDL = (
    "record_id bigint, `default` string, unit struct<raw:string,base:string,factor:double>, value_domain struct<kind:string,`from`:double,`to`:double,values:array<string>,pattern:string>,"
    "display_name string, description string, source_text string, field string, num string, amount string"
)


def run(spark, *rows):
    full = [(i, r.get("default"), r.get("unit"), r.get("domain"), r.get("name", "Hold Timer"), r.get("description", "of the record."), r.get("source"), "f", "n", "a") for i, r in enumerate(rows)]
    return {(x.record_id, x.field): (x.common_unit, x.amount) for x in converted(spark.createDataFrame(full, DDL)).collect()}


@pytest.mark.parametrize(
    "text, unit, amount",
    [
        ("1 000 ms", "us", 1_000_000), ("64,000 kbps", "bit/s", 64_000_000), ("1,5 s", "us", 1_500_000), ("25e2 bytes", "byte", 2500), ("~2 KiB", "byte", 2048), ("approx. 5 MB/s", "bit/s", 40_000_000),
        ("1'000 mm", "mm", 1000), ("0.5 %", "ppm", 5000), ("3 ‰", "ppm", 3000), ("2 μs", "us", 2), ("2 µs", "us", 2), ("7 000 hertz", "Hz", 7000), ("8 b", "byte", 1), ("8 B", "byte", 8), ("2,345,678 bps", "bit/s", 2345678), ("1 bits per second", "bit/s", 1),
    ],
)
def test_own_units(spark, text, unit, amount):
    assert run(spark, {"default": text}) == {(0, "default"): (unit, amount)}


def test_order_of_units(spark):
    rows = [
        {"default": "5 ms", "unit": ("s", "s", 1.0)},
        {"default": "5", "unit": ("[ms] ", "s", 1.0)},
        {"default": "5", "unit": ("n/a", "s", 0.001)},
        {"default": "5", "unit": (None, None, None), "name": "Hold Timer (ms)"},
        {"default": "5", "description": "Hold Timer of the record, given in ms per the annex."},
        {"default": "5", "unit": ("credits", None, None), "name": "Charge (ms)"},
    ]
    assert run(spark, *rows) == {(i, "default"): ("us", 5000) for i in range(5)}


def test_bounds(spark):
    made = lambda text: {"domain": ("free", None, None, [text], None)}
    got = run(spark, made("480–3840 Mbps"), made("up to 80 s"), made("≥ 5 kB"), made("40 ms to 400 ms"), made("at least 1km, at most 2km"), {"domain": ("enum", None, None, ["5 ms"], None)}, {"default": "2 kHz", "domain": ("range", 1.0, 4.0, None, None)})
    assert got == {
        (0, "from"): ("bit/s", 480_000_000), (0, "to"): ("bit/s", 3_840_000_000), (1, "to"): ("us", 80_000_000), (2, "from"): ("byte", 5000), (3, "from"): ("us", 40_000), (3, "to"): ("us", 400_000),
        (4, "from"): ("mm", 1_000_000), (4, "to"): ("mm", 2_000_000), (6, "default"): ("Hz", 2000), (6, "from"): ("Hz", 1000), (6, "to"): ("Hz", 4000),
    }


def test_no_amounts(spark):
    texts = [None, "", " ", "10GE", "802.3ad", "2025-03-01", "v2.1", "N+1", "as agreed", "15", "-3", "x" * 100_000]
    assert run(spark, *[{"default": t} for t in texts]) == {}
    assert converted(spark.createDataFrame([], DDL)).count() == 0
