"""Normal names of entities: blanks, wrapping, punctuation, dashes, case, singular, aliases, with a log of the steps.

Everything is a Column expression; only the compatibility normalisation of non-ASCII names needs Python.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.functions.text import strip
from specweave.session import table
from specweave.sources.lexicons import ALIASES

#: Words that only look like plurals; pairs that wrap a name.
NOT_PLURAL = ("cos", "status", "address", "class", "series", "access", "business", "gas", "bus")
WRAPS = ("\"\"", "''", "()", "[]", "{}", "“”", "‘’", "<>", "``")
_UNWRAP = "|".join(f"^\\Q{a}\\E(.*)\\Q{b}\\E$" for a, b in WRAPS)


def _compatible(names: pd.Series) -> pd.Series:
    return names.map(lambda n: unicodedata.normalize("NFKC", n) if isinstance(n, str) else n)


def unwrap(text: Column) -> Column:
    """Without the quotes and brackets around it, until none is left.

    Layers are taken off four at a time; what more there are, in steps over at most as many layers as the name is long.
    """

    def layer(c: Column) -> Column:
        return strip(F.regexp_replace(c, "(?s)" + _UNWRAP, "".join(f"${i}" for i in range(1, len(WRAPS) + 1))))

    few = text
    for _ in range(4):
        few = layer(few)
    more = F.aggregate(F.sequence(F.lit(0), F.length(few)), few, lambda c, _: F.when(c.rlike("(?s)" + _UNWRAP), layer(c)).otherwise(c))
    return F.when(few.rlike("(?s)" + _UNWRAP), more).otherwise(few)


def plain_dashes(text: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(text, "[-‐-―/]+", " "), r"(?U)\s+", " "))


def before_folding(text: Column) -> Column:
    """All steps up to, and without, lower case."""
    return plain_dashes(strip(F.regexp_replace(unwrap(F.regexp_replace(strip(text), r"(?U)\s+", " ")), r"[.,;:!?]+$", "")))


def singular(before: Column, folded: Column) -> Column:
    """The words of ``folded`` in the singular, acronyms (by their form in ``before``) left alone."""
    pairs = F.arrays_zip(F.split(before, " ").alias("b"), F.split(folded, " ").alias("f"))

    def one(p: Column) -> Column:
        b, f = p["b"], p["f"]
        keep = ((F.upper(b) == b) & b.rlike(r"\p{L}") & (F.length(b) > 1)) | (F.length(f) <= 3) | f.isin(*NOT_PLURAL) | f.contains("'")
        return F.when(keep, f).when(f.endswith("ies") & (F.length(f) > 4), F.regexp_replace(f, "ies$", "y")).when(f.endswith("s") & ~f.endswith("ss"), F.regexp_replace(f, "s$", "")).otherwise(f)

    return F.array_join(F.transform(pairs, one), " ")


def alias_table(aliases: dict[str, list[str]]) -> dict[str, str]:
    """Folded alias -> folded canonical name; the first canonical name wins."""
    fold = lambda s: " ".join(s.replace("-", " ").replace("/", " ").lower().split())
    out: dict[str, str] = {}
    for name, more in aliases.items():
        for a in more:
            if fold(a) != fold(name):
                out.setdefault(fold(a), fold(name))
    return out


def normalized(entities: DataFrame, name: str = "entity_name", aliases: dict[str, list[str]] = ALIASES) -> DataFrame:
    """Adds ``normalized_entity_name``, ``steps`` (what changed) and ``reasoning``."""
    raw = F.col(name)
    rows = entities.withColumn("_0", F.when(raw.rlike(r"[^\x00-\x7F]"), F.pandas_udf(_compatible, "string")(raw)).otherwise(raw))
    chain = [
        ("trim whitespace", lambda c: strip(c)),
        ("collapse whitespace", lambda c: F.regexp_replace(c, r"(?U)\s+", " ")),
        ("strip surrounding quotes/brackets", lambda c: unwrap(c)),
        ("strip trailing punctuation", lambda c: strip(F.regexp_replace(c, r"[.,;:!?]+$", ""))),
        ("normalize hyphen/dash/slash spacing", plain_dashes),
    ]
    logged = [F.when(F.col("_0") != raw, F.lit("NFKC unicode normalize"))]
    for i, (label, step) in enumerate(chain):
        rows = rows.withColumn(f"_{i + 1}", step(F.col(f"_{i}")))
        logged.append(F.when(F.col(f"_{i + 1}") != F.col(f"_{i}"), F.lit(label)))
    last = f"_{len(chain)}"
    rows = rows.withColumn("_folded", F.lower(last)).withColumn("_single", singular(F.col(last), F.col("_folded")))
    alias = F.try_element_at(F.create_map(*[F.lit(x) for kv in alias_table(aliases).items() for x in kv]), F.col("_single"))
    rows = rows.withColumn("_alias", alias)
    logged += [
        F.when(F.col("_folded") != F.col(last), F.lit("casefold")),
        F.when(F.col("_single") != F.col("_folded"), F.format_string("singularize plural token(s) (%s -> %s)", "_folded", "_single")),
        F.when(F.col("_alias").isNotNull(), F.concat(F.lit("alias of "), "_alias")),
    ]
    steps = F.array_compact(F.array(*logged))
    out = rows.withColumn("normalized_entity_name", F.coalesce("_alias", "_single")).withColumn("steps", steps)
    out = out.withColumn("reasoning", F.when(F.size("steps") > 0, F.array_join("steps", "; ")).otherwise(F.lit("no change")))
    return out.drop(*[f"_{i}" for i in range(len(chain) + 1)], "_folded", "_single", "_alias")


def q_normalized_names(spark: SparkSession, root: str) -> DataFrame:
    return normalized(table(spark, root, "entities").select("record_id", "entity_name")).select("record_id", F.col("normalized_entity_name").alias("normal"))


def q_normalized_ascii_names(spark: SparkSession, root: str) -> DataFrame:
    """The names that the SQL twin can follow: without any character beyond ASCII."""
    e = table(spark, root, "entities").filter(r"entity_name rlike '^[\\x00-\\x7F]*$'")
    return normalized(e.select("record_id", "entity_name")).select("record_id", F.col("normalized_entity_name").alias("normal"))


_WRAP_SQL = "trim(regexp_replace({0}, '^\"(.*)\"$|^''(.*)''$|^\\((.*)\\)$|^\\[(.*)\\]$|^\\{{(.*)\\}}$|^<(.*)>$|^`(.*)`$', '\\1\\2\\3\\4\\5\\6\\7', 's'))"
_W4 = "s1"
for _ in range(4):
    _W4 = _WRAP_SQL.format(_W4)
QUERIES = {"normalized_names": q_normalized_names, "normalized_ascii_names": q_normalized_ascii_names}
ORACLES = {
    "normalized_ascii_names": rf"""with t as (select record_id, regexp_replace(regexp_replace(entity_name, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g') as s1 from entities where regexp_matches(entity_name, '^[\x00-\x7F]*$')),
u as (select record_id, trim(regexp_replace(regexp_replace(trim(regexp_replace({_W4}, '[.,;:!?]+$', '')), '[-/]+', ' ', 'g'), '\s+', ' ', 'g')) as b from t),
v as (select record_id, array_to_string(list_transform(string_split(b, ' '), lambda w: case when (w = upper(w) and regexp_matches(w, '[A-Za-z]') and length(w) > 1) or length(w) <= 3 or lower(w) in ({", ".join(repr(x) for x in NOT_PLURAL)}) or contains(w, '''') then lower(w)
  when lower(w) like '%ies' and length(w) > 4 then lower(w)[:-4] || 'y' when lower(w) like '%s' and lower(w) not like '%ss' then lower(w)[:-2] else lower(w) end), ' ') as s from u)
select record_id, case s {" ".join(f"when '{a}' then '{n}'" for a, n in alias_table(ALIASES).items())} else s end as normal from v""",
}
