"""Declarations that drive the per-table work: table specs, layers and quality limits."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import types as T

INGESTED_AT = "_ingested_at"
# Partition column of bronze tables: one value per load.
LOAD_ID = "_load_id"
UPDATED_AT = "_updated_at"
DLQ_REASON = "_dlq_reason"
DLQ_TIMESTAMP = "_dlq_timestamp"
CORRUPT_RECORD = "_corrupt_record"

# The reasons written to the dead-letter tables.
DUPLICATE_KEY = "Duplicate Primary Key"
NULL_KEY = "Null Primary Key"
BAD_TIMESTAMP = "Invalid Timestamp"
MALFORMED_RECORD = "Malformed Record"

MONEY = T.DecimalType(18, 2)


@dataclass(frozen=True)
class TableSpec:
    """One source table: where it comes from, what identifies a row, how it is laid out."""

    name: str
    source: str
    keys: tuple[str, ...] = ()
    timestamp_column: str | None = None
    partition_by: tuple[str, ...] = ()
    # Declared column types by (sanitised) name. Undeclared columns stay strings;
    # with no declaration at all the CSV reader infers the types.
    types: Mapping[str, T.DataType] | None = None
    # For cells with line breaks. Each file is then read by one task, so files should be of the
    # size of a task, some hundred MB; larger ones are better split where they are made.
    multi_line: bool = False
    # The files differ in the order of their columns; costs one more pass.
    mixed_headers: bool = False
    # Physical lines that the raw file should have, header included; None if unknown.
    expected_lines: int | None = None
    # "null" keeps a row whose timestamp cannot be parsed, with a NULL timestamp;
    # "reject" sends it to the dead-letter table.
    bad_timestamps: str = "null"
    # Route rows with a NULL key to the dead-letter table before looking for duplicates.
    null_keys_first: bool = False
    description: str = ""

    def __post_init__(self):
        if self.bad_timestamps not in ("null", "reject"):
            raise ValueError(f"bad_timestamps must be 'null' or 'reject', not {self.bad_timestamps!r}")
        if self.partition_by and not self.timestamp_column:
            raise ValueError(f"{self.name}: partition_by needs a timestamp_column")
        unknown = set(self.partition_by) - {"year", "month"}
        if unknown:
            raise ValueError(f"{self.name}: cannot partition by {sorted(unknown)}")

    @classmethod
    def from_mapping(cls, entry: Mapping) -> TableSpec:
        """Build a spec from one entry of a table configuration file.

        ``types`` maps column names to type names; an unknown key is an error.
        """
        unknown = set(entry) - _ENTRY_KEYS
        if unknown:
            raise ValueError(f"{entry.get('name')}: unknown keys {', '.join(sorted(unknown))}")
        types = entry.get("types")
        lines = entry.get("expected_lines")
        return cls(
            name=entry["name"],
            source=entry["source_file"],
            keys=tuple(entry.get("key_columns") or ()),
            timestamp_column=entry.get("timestamp_column"),
            partition_by=tuple(entry.get("partition_by") or ()),
            types=None if types is None else {n: parse_type(t) for n, t in types.items()},
            multi_line=bool(entry.get("multi_line", False)),
            mixed_headers=bool(entry.get("mixed_headers", False)),
            expected_lines=None if lines is None else int(lines),
            bad_timestamps=entry.get("bad_timestamps", "null"),
            null_keys_first=bool(entry.get("null_keys_first", False)),
            description=entry.get("description", ""),
        )


_ENTRY_KEYS = frozenset(
    {
        "name",
        "source_file",
        "key_columns",
        "timestamp_column",
        "partition_by",
        "types",
        "multi_line",
        "mixed_headers",
        "expected_lines",
        "bad_timestamps",
        "null_keys_first",
        "description",
    }
)

_TYPE_NAMES = {
    "string": T.StringType,
    "int": T.IntegerType,
    "integer": T.IntegerType,
    "bigint": T.LongType,
    "long": T.LongType,
    "float": T.FloatType,
    "double": T.DoubleType,
    "boolean": T.BooleanType,
    "date": T.DateType,
    "timestamp": T.TimestampType,
    "timestamp_ntz": T.TimestampNTZType,
}


def parse_type(name: str) -> T.DataType:
    """The type of a name such as ``int``, ``timestamp`` or ``decimal(18,2)``."""
    plain = name.strip().lower()
    if plain in _TYPE_NAMES:
        return _TYPE_NAMES[plain]()
    if decimal := re.fullmatch(r"decimal\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)", plain):
        return T.DecimalType(int(decimal[1]), int(decimal[2]))
    raise ValueError(f"unknown type {name!r}")


@dataclass(frozen=True)
class Layers:
    """Namespaces of the session catalog, one per layer."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    dlq: str = "dlq"
    ops: str = "ops"
    bi: str = "bi"
    # Folder for new namespaces; None leaves the choice to the catalog's warehouse.
    location: str | None = None
    # Table format of the layer tables.
    file_format: str = "parquet"

    @classmethod
    def prefixed(cls, prefix: str, location: str | None = None) -> Layers:
        names = ("bronze", "silver", "gold", "dlq", "ops", "bi")
        return cls(*(f"{prefix}_{n}" for n in names), location=location)


@dataclass(frozen=True)
class QualityThresholds:
    """Highest tolerated ratios. The defaults below."""

    max_null_ratio: float = 0.05
    max_duplicate_ratio: float = 0.01
    fail_on_quality_error: bool = False


def load_config(path: str) -> dict:
    """A configuration file: JSON, or YAML where a YAML reader is installed."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as error:
        raise ValueError(f"{path}: no YAML reader is installed, use JSON") from error
    return yaml.safe_load(text)


def load_specs(path: str) -> tuple[TableSpec, ...]:
    """The entries below ``tables`` of a configuration file."""
    return tuple(TableSpec.from_mapping(entry) for entry in load_config(path).get("tables") or ())


def load_thresholds(path: str) -> QualityThresholds:
    """The entries below ``quality`` of a configuration file."""
    return QualityThresholds(**(load_config(path).get("quality") or {}))


def _retail() -> tuple[TableSpec, ...]:
    # Names, keys, timestamp and partition columns of the nine tables.
    s, i, d, ts = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()
    return (
        TableSpec(
            "customers",
            "customers.csv",
            keys=("customer_id",),
            types={
                "customer_id": s,
                "customer_unique_id": s,
                "customer_zip_code_prefix": s,
                "customer_city": s,
                "customer_state": s,
            },
            description="Customers and where they live",
        ),
        TableSpec(
            "orders",
            "orders.csv",
            keys=("order_id",),
            timestamp_column="order_purchase_timestamp",
            partition_by=("year", "month"),
            types={
                "order_id": s,
                "customer_id": s,
                "order_status": s,
                "order_purchase_timestamp": ts,
                "order_approved_at": ts,
                "order_delivered_customer_date": ts,
                "order_estimated_delivery_date": ts,
            },
            description="Orders with status and timestamps",
        ),
        TableSpec(
            "order_items",
            "order_items.csv",
            keys=("order_id", "order_item_id"),
            types={
                "order_id": s,
                "order_item_id": i,
                "product_id": s,
                "seller_id": s,
                "price": MONEY,
                "freight_value": MONEY,
            },
            description="Items of each order",
        ),
        TableSpec(
            "order_payments",
            "order_payments.csv",
            keys=("order_id", "payment_sequential"),
            types={
                "order_id": s,
                "payment_sequential": i,
                "payment_type": s,
                "payment_installments": i,
                "payment_value": MONEY,
            },
            description="Payments of each order",
        ),
        TableSpec(
            "order_reviews",
            "order_reviews.csv",
            keys=("review_id",),
            timestamp_column="review_creation_date",
            types={"review_id": s, "order_id": s, "review_score": i, "review_creation_date": ts},
            multi_line=True,
            description="Review scores and comments",
        ),
        TableSpec(
            "products",
            "products.csv",
            keys=("product_id",),
            types={
                "product_id": s,
                "product_category_name": s,
                "product_name_lenght": i,
                "product_description_lenght": i,
                "product_photos_qty": i,
                "product_weight_g": d,
                "product_length_cm": d,
                "product_height_cm": d,
                "product_width_cm": d,
            },
            description="Product category, texts and sizes",
        ),
        TableSpec(
            "sellers",
            "sellers.csv",
            keys=("seller_id",),
            types={"seller_id": s, "seller_zip_code_prefix": s, "seller_city": s, "seller_state": s},
            description="Sellers and where they are",
        ),
        TableSpec(
            "geolocation",
            "geolocation.csv",
            keys=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
            types={
                "geolocation_zip_code_prefix": s,
                "geolocation_lat": d,
                "geolocation_lng": d,
                "geolocation_city": s,
                "geolocation_state": s,
            },
            description="Coordinates of zip code prefixes",
        ),
        TableSpec(
            "category_translation",
            "category_translation.csv",
            keys=("product_category_name",),
            types={"product_category_name": s, "product_category_name_english": s},
            description="English names of product categories",
        ),
    )


RETAIL_TABLES = _retail()

# Physical lines expected in the raw files, header included.
RETAIL_LINE_COUNTS = {
    "customers": 99442,
    "geolocation": 1000164,
    "order_items": 112651,
    "order_payments": 103887,
    "order_reviews": 104720,
    "orders": 99442,
    "products": 32952,
    "sellers": 3096,
    "category_translation": 72,
}


def retail_specs(sources: Mapping[str, str] | None = None, **overrides) -> tuple[TableSpec, ...]:
    """The nine retail tables; ``sources`` maps a table name to its file, folder or glob."""
    sources = sources or {}
    return tuple(replace(t, source=sources.get(t.name, t.source), **overrides) for t in RETAIL_TABLES)


def expected_lines(specs: Iterable[TableSpec]) -> dict[str, int]:
    """Expected line counts by source: those of the specs, else those known for the retail tables."""
    known = {s.source: s.expected_lines or RETAIL_LINE_COUNTS.get(s.name) for s in specs}
    return {source: lines for source, lines in known.items() if lines is not None}
