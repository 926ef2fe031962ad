"""Term lists of the telecom domain and the lookups made from them.

All lists are defaults: a ``Lexicon`` can be built with others, known entities also from a table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.functions.text import norm

# Known entities (name: layer, type, aliases).
KNOWN_ENTITIES = {
    "EVC": ("CFS", "Service", ["Ethernet Virtual Connection", "Ethernet Virtual Circuit"]),
    "UNI": ("Resource", "Interface", ["User Network Interface", "User-Network Interface"]),
    "ENNI": ("Resource", "Interface", ["External Network-Network Interface"]),
    "OVC": ("RFS", "Service", ["Operator Virtual Connection"]),
    "Subscriber": ("Party", "Party", ["subscriber"]),
    "Customer": ("Party", "Party", ["customer", "end customer"]),
    "Service Provider": ("Party", "Party", ["operator", "provider"]),
    "Order": ("Other", "BusinessInteraction", ["service order", "product order"]),
    "Product": ("Other", "Product", ["product offering"]),
    "Service": ("CFS", "Service", []),
    "Bandwidth Profile": ("RFS", "Policy", ["BWP"]),
    "SIM": ("Resource", "PhysicalResource", ["SIM card", "UICC"]),
    "Device": ("Resource", "PhysicalResource", ["user equipment", "UE", "terminal"]),
    "Access Point": ("Resource", "LogicalResource", []),
    "Bill": ("Other", "CustomerBill", ["invoice"]),
    "Account": ("Party", "Account", ["customer account", "billing account"]),
}
# Aliases that also hold for names outside of the known entities.
ALIASES = {
    "EVC": ["Ethernet Virtual Connection", "Ethernet Virtual Circuit"],
    "UNI": ["User Network Interface", "User-Network Interface"],
    "ENNI": ["External Network-Network Interface", "External Network Network Interface"],
    "OVC": ["Operator Virtual Connection"],
    "E-Line": ["Ethernet Line", "Ethernet Private Line", "EPL"],
    "E-LAN": ["Ethernet LAN"],
    "Subscriber": ["end user", "end-user"],
    "Service Provider": ["operator", "SP"],
    "SIM": ["SIM card", "UICC"],
    "SLA": ["Service Level Agreement"],
    "CoS": ["Class of Service"],
}
# Attribute gazetteer (name: expansions).
GAZETTEER = {
    "MSISDN": ["Mobile Station International Subscriber Directory Number", "mobile number"],
    "IMSI": ["International Mobile Subscriber Identity"],
    "ICCID": ["Integrated Circuit Card Identifier"],
    "IMEI": ["International Mobile Equipment Identity"],
    "APN": ["Access Point Name"],
    "VLAN ID": ["VLAN identifier", "VLAN", "C-VLAN ID", "S-VLAN ID", "CE-VLAN ID"],
    "CIR": ["Committed Information Rate"],
    "PIR": ["Peak Information Rate"],
    "EIR": ["Excess Information Rate"],
    "CBS": ["Committed Burst Size"],
    "EBS": ["Excess Burst Size"],
    "DSCP": ["Differentiated Services Code Point"],
    "CoS": ["Class of Service", "CoS Name", "CoS ID"],
    "PLMN": ["Public Land Mobile Network", "PLMN ID"],
    "RAT type": ["Radio Access Technology", "RAT"],
    "MRC": ["Monthly Recurring Charge"],
    "NRC": ["Non-Recurring Charge"],
    "SLA tier": ["SLA", "Service Level Agreement tier", "SLA level"],
    "MTU": ["Maximum Transmission Unit"],
    "QoS": ["Quality of Service"],
    "EVC ID": ["EVC identifier"],
    "UNI ID": ["UNI identifier"],
    "Port Speed": ["port rate", "interface speed"],
    "MAC Address": ["MAC", "Media Access Control address"],
    "Physical Medium": ["physical layer", "medium"],
    "Service Type": ["service kind"],
    "Bandwidth Profile": ["BWP"],
    "Frame Delay": ["FD", "one-way frame delay"],
    "Frame Loss Ratio": ["FLR"],
    "Availability": ["service availability"],
}
# Head nouns that denote a property, by kind.
PROPERTY_NOUNS = {
    "measure": [
        "bandwidth", "latency", "jitter", "throughput", "mtu", "rate", "speed", "size", "length", "capacity", "delay", "loss",
        "utilization", "frequency", "power", "weight", "height", "width", "depth", "temperature", "volume", "count", "quantity", "amount",
        "cost", "price", "fee", "charge", "limit", "threshold", "percentage", "ratio",
    ],
    "identifier": [
        "id", "identifier", "code", "number", "reference", "key", "index", "tag", "label", "address", "msisdn", "imsi", "iccid", "imei",
        "uri", "url",
    ],
    "status": [
        "status", "state", "condition", "flag", "indicator",
    ],
    "temporal": [
        "date", "time", "timestamp", "duration", "ttl", "validity", "period", "interval", "timeout", "expiry", "expiration", "deadline",
        "schedule", "start", "end",
    ],
    "descriptor": [
        "name", "type", "class", "category", "priority", "level", "mode", "version", "description", "format", "medium", "protocol",
        "profile", "tier", "grade", "role", "kind", "scheme", "encoding", "colour", "color", "model", "vendor", "manufacturer", "region",
        "zone", "country", "currency", "language", "unit", "direction", "topology", "standard",
    ],
}
# Aggregate business entities.
BUSINESS_ENTITIES = (
    "Party", "Party Role", "Customer", "Customer Account", "Customer Bill", "Customer Order", "Customer Interaction", "Product", "Product Offering",
    "Product Specification", "Product Price", "Product Order", "Service", "Customer Facing Service", "Resource Facing Service", "Service Specification",
    "Service Order", "Service Level Agreement", "Resource", "Physical Resource", "Logical Resource", "Resource Specification", "Resource Order",
    "Location", "Agreement", "Business Interaction", "Usage", "Policy",
)
# Verbs whose subject has a life cycle.
LIFECYCLE_VERBS = [
    "created", "submitted", "suspended", "terminated", "activated", "deactivated", "cancelled", "canceled", "provisioned",
        "deprovisioned", "approved", "rejected", "fulfilled", "completed", "closed", "opened", "initiated", "ordered", "delivered",
        "installed", "decommissioned", "renewed", "expired", "modified", "amended", "updated", "deleted", "archived",
    ]
# Patterns of page furniture, case aside.
FURNITURE = (
    r"^\s*figure\s+\d+", r"^\s*fig\.\s*\d+", r"^\s*table\s+\d+\s*[-–—:]", r"^\s*table\s+\d+\s*$", r"^\s*appendix\b", r"^\s*annex\b", r"revision\s+history",
    r"document\s+history", r"table\s+of\s+contents", r"^\s*page\s+\d+(\s+of\s+\d+)?\s*$", r"^\s*\d+\s*/\s*\d+\s*$", r"^\s*©|copyright\s+\d{4}",
    r"all\s+rights\s+reserved", r"^\s*confidential\s*$", r"^\s*list\s+of\s+(figures|tables)",
)
# Names too general for an entity.
GENERIC_TERMS = ("system", "data", "information", "value", "item", "thing", "object", "element")


def plain(text: str) -> str:
    return " ".join(text.strip().lower().split())


@dataclass(frozen=True)
class Lexicon:
    known: dict[str, tuple[str | None, str | None, list[str]]] = field(default_factory=lambda: KNOWN_ENTITIES)
    aliases: dict[str, list[str]] = field(default_factory=lambda: ALIASES)
    gazetteer: dict[str, list[str]] = field(default_factory=lambda: GAZETTEER)
    property_nouns: dict[str, list[str]] = field(default_factory=lambda: PROPERTY_NOUNS)
    business: tuple[str, ...] = BUSINESS_ENTITIES
    lifecycle_verbs: tuple[str, ...] = tuple(LIFECYCLE_VERBS)
    furniture: tuple[str, ...] = FURNITURE
    generic: tuple[str, ...] = GENERIC_TERMS

    @staticmethod
    def from_table(known: DataFrame, most: int = 20_000) -> Lexicon:
        """The default lists with the known entities of a table (name, layer, entity_type, aliases) of at most ``most``
        rows, a bound that is checked."""
        rows = known.select("known_id", "name", "layer", "entity_type", "aliases").orderBy("known_id").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} known entities: too many for a lexicon")
        return Lexicon(known={r.name: (r.layer, r.entity_type, list(r.aliases or [])) for r in rows if r.name and r.name.strip()})

    @staticmethod
    def from_yaml(path: str) -> Lexicon:
        """The default lists, of which a YAML file (known_entities, aliases, gazetteer, property_nouns, business,
        lifecycle_verbs, furniture, generic) replaces those that it has."""
        import yaml

        with open(path, encoding="utf-8") as source:
            given = yaml.safe_load(source) or {}
        known = given.pop("known_entities", None)
        unknown = set(given) - {"aliases", "gazetteer", "property_nouns", "business", "lifecycle_verbs", "furniture", "generic"}
        if unknown:
            raise ValueError(f"unknown lists: {', '.join(sorted(unknown))}")
        lists = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items()}
        if known is not None:
            lists["known"] = {n: ((x or {}).get("layer"), (x or {}).get("type"), list((x or {}).get("aliases") or [])) for n, x in known.items()}
        return Lexicon(**lists)

    # -- lookups as dictionaries: later entries of the known entities win, aliases fill what is absent
    def entity_keys(self) -> dict[str, str]:
        keys: dict[str, str] = {}
        for name, (_, _, aliases) in self.known.items():
            keys |= {plain(t): name for t in (name, *aliases)}
        for name, aliases in self.aliases.items():
            for t in (name, *aliases):
                keys.setdefault(plain(t), name)
        return keys

    def gazetteer_keys(self) -> dict[str, str]:
        return {plain(t): name for name, more in self.gazetteer.items() for t in (name, *more)}

    def alias_keys(self) -> dict[str, str]:
        return {plain(t): name for name, more in self.aliases.items() for t in (name, *more)}

    def noun_kinds(self) -> dict[str, str]:
        return {plain(n): kind for kind, nouns in self.property_nouns.items() for n in nouns}

    # -- lookups as Columns (maps of a fixed, small number of entries)
    def noun_kind(self, word: Column) -> Column:
        return lookup(self.noun_kinds(), norm(word))

    def gazetteer_match(self, text: Column) -> Column:
        return lookup(self.gazetteer_keys(), norm(text))

    def alias_canonical(self, text: Column) -> Column:
        return lookup(self.alias_keys(), norm(text))

    def expansions(self, canonical: Column, lists: dict[str, list[str]]) -> Column:
        table = F.create_map(*[x for name, more in lists.items() for x in (F.lit(name), F.array(*[F.lit(m) for m in more]) if more else F.array().cast("array<string>"))])
        return F.try_element_at(table, canonical)

    def is_furniture(self, text: Column) -> Column:
        return text.rlike("(?iuU)" + "|".join(f"(?:{p})" for p in self.furniture))

    # -- lookups as DataFrames, for joins
    def entity_lookup(self, spark: SparkSession) -> DataFrame:
        """key, name, layer, type of the known entities by every spelling."""
        rows = [(k, n, *self.known[n][:2]) for k, n in self.entity_keys().items() if n in self.known]
        return spark.createDataFrame(rows, "key string, name string, layer string, type string")

    def mention_terms(self, spark: SparkSession) -> DataFrame:
        """source (entity, gazetteer), canonical, canonical_ord, term, term_ord: what is looked for in prose."""
        rows = [("entity", n, i, n, 0) for i, n in enumerate(self.known)]
        rows += [("gazetteer", n, i, t, j) for i, (n, more) in enumerate(self.gazetteer.items()) for j, t in enumerate((n, *more))]
        return spark.createDataFrame(rows, "source string, canonical string, canonical_ord int, term string, term_ord int")

    def lexicon_terms(self, spark: SparkSession) -> DataFrame:
        """The terms by which entities are found in chunks: names and aliases of known entities, names of business entities."""
        found = {n: [n, *more] for n, (_, _, more) in self.known.items()}
        for n in self.business:
            found.setdefault(n, [n])
        rows = [("lexicon", n, i, t, j) for i, (n, terms) in enumerate(found.items()) for j, t in enumerate(terms)]
        return spark.createDataFrame(rows, "source string, canonical string, canonical_ord int, term string, term_ord int")


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a key in a small fixed dictionary, as a literal map; null if absent."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)
