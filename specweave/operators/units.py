"""Quantities recorded in different units, brought to one common unit per kind.

Plain SQL: number and unit are taken out of the texts with ``regexp_extract``, every unit spelling is normalised by a join
with the alias table, the unit is the first of (own unit, ``unit.raw``, ``unit.base`` x ``unit.factor``, a unit named
elsewhere in the record), and the amount is number x factor + offset in decimal arithmetic.

Defined results
    * a value whose own unit is unknown (``10GE``, ``802.3ad``, a date) is no amount, whatever else the record says;
    * ``unit.raw`` that names another kind (``credits``, ``dBm``) makes values without an own unit no amounts;
    * null, empty and blank values, enum values and values without any unit give no row;
    * ``from`` and ``to`` come from the numbers of value_domain, else from its words (``up to 80 s``, ``>= 5 ms``,
      ``40 ms to 400 ms``, ``1-10 Gbit/s``, ``at least 1 s, at most 5 s``);
    * halves round away from zero; repeated rows give repeated amounts (each has its own record_id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from specweave.session import table

#: Common unit, factor to it, spellings.  Spellings of five or more characters without a slash are compared
#: in lower case, all others as written (b is a bit, B a byte, m a metre, M mega).
UNITS = (
    ("bit/s", "1", "bps|b/s|bit/s|Bit/s|bits/s|bits per second|bit per second"),
    ("bit/s", "1000", "kbps|Kbps|KBPS|kbit/s|Kbit/s|kBit/s|KBit/s|kb/s|Kb/s|kilobits per second|kilobit per second|kilobit/s|kilobits/s"),
    ("bit/s", "1000000", "mbps|Mbps|MBPS|Mbit/s|MBit/s|mbit/s|Mb/s|mb/s|megabits per second|megabit per second|megabit/s|megabits/s"),
    ("bit/s", "1000000000", "gbps|Gbps|GBPS|Gbit/s|GBit/s|gbit/s|Gb/s|gb/s|gigabits per second|gigabit per second|gigabit/s|gigabits/s"),
    ("bit/s", "1000000000000", "Tbps|tbps|Tbit/s|TBit/s|Tb/s|terabits per second"),
    ("bit/s", "8", "B/s|byte/s|bytes/s|bytes per second"),
    ("bit/s", "8000", "kB/s|KB/s|kilobytes per second|kilobytes/s"),
    ("bit/s", "8000000", "MB/s|megabytes per second|megabytes/s"),
    ("bit/s", "8000000000", "GB/s|gigabytes per second|gigabytes/s"),
    ("bit/s", "8192", "KiB/s"),
    ("bit/s", "8388608", "MiB/s"),
    ("us", "0.001", "ns|nsec|nanosecond|nanoseconds"),
    ("us", "1", "us|µs|usec|µsec|microsecond|microseconds"),
    ("us", "1000", "ms|msec|millisecond|milliseconds|msecs"),
    ("us", "1000000", "s|sec|secs|second|seconds|sec.|S"),
    ("us", "60000000", "min|mins|minute|minutes|min."),
    ("us", "3600000000", "h|hr|hrs|hour|hours"),
    ("us", "86400000000", "d|day|days"),
    ("byte", "0.125", "bit|bits|b"),
    ("byte", "1", "B|byte|bytes|Byte|octet|octets"),
    ("byte", "1000", "kB|KB|kilobyte|kilobytes|kbyte|kbytes"),
    ("byte", "1000000", "MB|megabyte|megabytes|mbyte|mbytes"),
    ("byte", "1000000000", "GB|gigabyte|gigabytes|gbyte|gbytes"),
    ("byte", "1000000000000", "TB|terabyte|terabytes"),
    ("byte", "1024", "KiB|kiB|kibibyte|kibibytes"),
    ("byte", "1048576", "MiB|mebibyte|mebibytes"),
    ("byte", "1073741824", "GiB|gibibyte|gibibytes"),
    ("byte", "1099511627776", "TiB"),
    ("ppm", "10000", "%|percent|per cent|pct|pct.|Percent"),
    ("ppm", "1000", "‰|per mille|permille|per mil|promille"),
    ("ppm", "1", "ppm|PPM|parts per million"),
    ("Hz", "1", "Hz|hz|HZ|hertz"),
    ("Hz", "1000", "kHz|KHz|khz|kilohertz"),
    ("Hz", "1000000", "MHz|Mhz|mhz|megahertz"),
    ("Hz", "1000000000", "GHz|Ghz|ghz|gigahertz"),
    ("mm", "0.001", "µm|um|micrometre|micrometres|micrometer|micrometers"),
    ("mm", "1", "mm|millimetre|millimetres|millimeter|millimeters"),
    ("mm", "10", "cm|centimetre|centimetres|centimeter|centimeters"),
    ("mm", "1000", "m|metre|metres|meter|meters"),
    ("mm", "1000000", "km|kilometre|kilometres|kilometer|kilometers"),
)

#: What stands in unit.raw when it says nothing.
NOTHING = ("", "-", "--", "–", "—", "?", "n/a", "na", "none", "null", "tbd", "tbc", "unknown", "see text", "as text", "see description")

_NB = "\u00a0\u202f\u2007\u2009"
_NUMBER = rf"(-?(?:[0-9]{{1,3}}(?:[ ,'’{_NB}][0-9]{{3}})+|[0-9]+)(?:[.,][0-9]+)?(?:[eE][+-]?[0-9]+)?)"
_ABOUT = r"(?:~|≈|±|approx\.?|approximately|about|circa|ca\.?|around)?"
_GAP = rf"[\s{_NB}]*"
_VALUE = rf"^{_GAP}{_ABOUT}{_GAP}{_NUMBER}{_GAP}([^0-9\s][^|]*)?$"
_LOWER = rf"(?:at least|from|≥|>=|>|min\.?|minimum|above|more than|over){_GAP}{_ABOUT}{_GAP}{_NUMBER}{_GAP}([^0-9,;–—]*)"
_UPPER = rf"(?:at most|up to|≤|<=|<|max\.?|maximum|below|less than|under){_GAP}{_ABOUT}{_GAP}{_NUMBER}{_GAP}([^0-9,;–—]*)"
_RANGE = rf"^{_GAP}(?:from|between)?{_GAP}{_ABOUT}{_GAP}{_NUMBER}{_GAP}([^0-9–—]*?){_GAP}(?:–|—|-|to|and|\.\.+|…){_GAP}{_NUMBER}{_GAP}([^0-9]*)$"
_NAMED = r"(?:in|are|is|units?:?) +([^ .;,]+(?: [^ .;,]+){0,2}?)(?: per the [a-z]+)?\.? *$"
_BRACKET = r"[\[(]([^\[\]()|]+)[\])] *$"
_CELL = r"^ *\|[^|]*[\[(]([^\[\]()|]+)[\])] *\|"

_DIALECTS = {
    "spark": {"r": "r", "q": "`", "g": "", "join": "array_join", "attributes": "{attributes}", "struct": "named_struct('field', {0}, 'common_unit', {1}, 'num', {2}, 'factor', {3}, 'offset_', {4})", "rows": "explode(array({0}))"},
    "duckdb": {"r": "", "q": '"', "g": ", 'g'", "join": "array_to_string", "attributes": "attributes", "struct": "struct_pack(field := {0}, common_unit := {1}, num := {2}, factor := {3}, offset_ := {4})", "rows": "unnest([{0}])"},
}


def conversion_sql(dialect: str) -> str:
    """The whole conversion as one SQL text, for Spark or for DuckDB."""
    d = _DIALECTS[dialect]

    def lit(text: str) -> str:
        quoted = text.replace("'", "\\x27")  # in a pattern only
        return f"{d['r']}'{quoted}'"

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    def part(source: str, pattern: str, group: int) -> str:
        return f"nullif(regexp_extract({source}, {lit(pattern)}, {group}), '')"

    def spelled(unit: str) -> str:
        """The comparison form of a unit's spelling."""
        plain = f"trim(regexp_replace(regexp_replace(replace({unit}, 'μ', 'µ'), {lit(r'^[\[(]|[\])]$')}, ''{d['g']}), {lit(rf'[\s{_NB}]+')}, ' '{d['g']}))"
        bare = f"trim(regexp_replace({plain}, {lit(r'^[\[( ]+|[\]). ]+$')}, ''{d['g']}))"
        return f"case when length({bare}) >= 5 and position('/' in {bare}) = 0 then lower({bare}) else {bare} end"

    def number(raw: str) -> str:
        solid = f"regexp_replace({raw}, {lit(f"[ '’{_NB}]")}, ''{d['g']})"
        comma = f"case when regexp_like({solid}, {lit('^-?[0-9]+(,[0-9]{3})+([.][0-9]+)?([eE].*)?$')}) then replace({solid}, ',', '') else replace({solid}, ',', '.') end"
        if dialect == "duckdb":
            comma = comma.replace("regexp_like", "regexp_matches")
        return f"try_cast({comma} as decimal(24,9))"

    aliases = ", ".join(
        f"({text(form)}, {text(kind)}, cast({factor} as decimal(20,6)), cast(0 as decimal(20,6)))"
        for kind, factor, names in UNITS
        for form in dict.fromkeys(n.lower() if len(n) >= 5 and "/" not in n else n for n in names.split("|"))
    )
    nothing = ", ".join(text(x) for x in NOTHING)
    mentions = ("own_default", "own_from", "own_to", "raw", "base", "shown", "named", "cell")
    joins = "\n".join(f"left join aliases a_{m} on a_{m}.alias = {spelled('t.' + m)}" for m in mentions)
    units = ", ".join(f"a_{m}.kind as {m}_kind, a_{m}.factor as {m}_factor, a_{m}.offset_ as {m}_offset" for m in mentions)

    def elsewhere(column: str) -> str:
        return "coalesce(" + ", ".join(f"{m}_{column}" for m in ("shown", "named", "cell", "own_default", "own_from", "own_to")) + ")"

    def field(name: str, value: str, own: str) -> str:
        silent = f"({own} is null and raw_silent)"
        kind = f"case when {own} is not null then {own}_kind when not raw_silent then raw_kind when base is not null then base_kind else {elsewhere('kind')} end"
        factor = f"case when {own} is not null then {own}_factor when not raw_silent then raw_factor when base is not null then cast(base_factor * base_times as decimal(20,6)) else {elsewhere('factor')} end"
        offset = f"case when {silent} and base is null then {elsewhere('offset')} when {own} is not null then {own}_offset when {silent} then base_offset else raw_offset end"
        return d["struct"].format(text(name), kind, value, factor, offset)

    fields = [
        field("default", number("default_raw"), "own_default"),
        field("from", f"coalesce(from_num, {number('from_raw')})", "own_from"),
        field("to", f"coalesce(to_num, {number('to_raw')})", "own_to"),
    ]
    vd, q = "value_domain", d["q"]
    return f"""
with aliases as (select * from (values {aliases}) as v(alias, kind, factor, offset_)),
worded as (
  select record_id, {q}default{q} as default_text, unit.raw as raw_text, unit.base as base_text, unit.factor as base_times_raw, display_name, description, source_text,
    case when {vd}.kind = 'enum' then null else cast({vd}.{q}from{q} as decimal(24,9)) end as from_num,
    case when {vd}.kind = 'enum' then null else cast({vd}.{q}to{q} as decimal(24,9)) end as to_num,
    case when {vd}.kind = 'enum' then null else {d['join']}({vd}.{q}values{q}, '; ') end as words
  from {d['attributes']}),
taken as (
  select record_id, from_num, to_num, raw_text, base_text,
    {part('default_text', _VALUE, 1)} as default_raw, {part('default_text', _VALUE, 2)} as own_default,
    coalesce({part('words', _RANGE, 1)}, {part('words', _LOWER, 1)}) as from_raw,
    coalesce({part('words', _RANGE, 3)}, {part('words', _UPPER, 1)}) as to_raw,
    coalesce({part('words', _RANGE, 2)}, {part('words', _RANGE, 4)}, {part('words', _LOWER, 2)}) as word_from,
    coalesce({part('words', _RANGE, 4)}, {part('words', _RANGE, 2)}, {part('words', _UPPER, 2)}) as word_to,
    raw_text as raw, nullif(trim(base_text), '') as base, cast(coalesce(base_times_raw, 1) as decimal(20,9)) as base_times,
    coalesce(lower({spelled('raw_text')}), '') in ({nothing}) as raw_silent,
    {part('display_name', _BRACKET, 1)} as shown, {part('description', _NAMED, 1)} as named, {part('source_text', _CELL, 1)} as cell
  from worded),
t as (select *, case when from_num is null then word_from end as own_from, case when to_num is null then word_to end as own_to from taken),
resolved as (select t.*, {units} from t {joins}),
amounts as (select record_id, {d['rows'].format(', '.join(fields))} as x from resolved)
select record_id, x.field as field, x.common_unit as common_unit, cast(round(x.num * x.factor + x.offset_, 0) as bigint) as amount
from amounts where x.num is not null and x.common_unit is not null
"""


def converted(attributes: DataFrame) -> DataFrame:
    """record_id, field (default, from, to), common_unit and amount of every quantity in ``attributes``."""
    escaped = conversion_sql("spark").replace("{", "{{").replace("}", "}}").replace("{{attributes}}", "{attributes}")
    return attributes.sparkSession.sql(escaped, attributes=attributes)


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return converted(table(spark, root, "attributes"))


QUERIES = {"p3_found": p3_found}
ORACLES = {"p3_found": conversion_sql("duckdb")}
