"""Declarative descriptions of every entity, dimension and fact.

The operators hold no table names: what differs between entities is stated here as data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Column kinds -> (type a variant value is read as, type the column is stored as).
# Whole numbers are read as decimal(38,0) first so that fractions round instead of truncating.
KINDS = {
    "long": ("decimal(38,0)", "bigint"),
    "money": ("decimal(18,2)", "decimal(18,2)"),
    "string": ("string", "string"),
    "boolean": ("boolean", "boolean"),
    "timestamp": ("timestamp_ntz", "timestamp_ntz"),
}


@dataclass(frozen=True)
class Rule:
    """One data-quality rule: rows for which ``check`` holds on ``column`` are rejected.

    Checks: ``negative`` (typed value < 0), ``absent`` (field not in the record; an explicit
    JSON null is present), ``null`` (typed value is NULL), ``blank`` (absent, or only spaces),
    ``not_email`` (text without an @).
    """

    error_type: str
    check: str
    column: str


@dataclass(frozen=True)
class HashPart:
    """One input of the change hash. Raw JSON text by default, the typed value if ``typed``."""

    column: str
    default: str = ""
    typed: bool = False


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: str
    fields: tuple[tuple[str, str], ...]
    rules: tuple[Rule, ...]
    hash_parts: tuple[HashPart, ...] = ()
    dates: tuple[tuple[str, str], ...] = ()  # (date column, timestamp column it is cut from)
    newest_by: tuple[str, ...] = ("updated_at",)
    update: tuple[str, ...] = ()
    insert_only: bool = False
    # Options that depart from the literal behaviour; all off by default.
    require_key: bool = False
    lenient_casts: bool = False
    guard_newer: bool = False

    @property
    def path(self) -> str:
        return f"{self.name}_raw/"

    @property
    def columns(self) -> tuple[str, ...]:
        """Stored columns in order, lineage included."""
        cols: list[str] = []
        cut = {ts: d for d, ts in self.dates}
        for name, _ in self.fields:
            cols.append(name)
            if name in cut:
                cols.append(cut[name])
        if self.hash_parts:
            cols.append("hash_value")
        return (*cols, "source_file", "ingestion_ts")

    @property
    def schema(self) -> str:
        kinds = dict(self.fields)
        types = {c: KINDS[k][1] for c, k in kinds.items()}
        types |= {d: "date" for d, _ in self.dates}
        types |= {"hash_value": "string", "source_file": "string", "ingestion_ts": "timestamp_ntz"}
        return ", ".join(f"`{c}` {types[c]}" for c in self.columns)

    @property
    def tiebreak(self) -> tuple[str, ...]:
        """Columns that order equally new images; rows equal in all of them are the same row."""
        skip = {self.key, "ingestion_ts", *self.newest_by}
        return ("source_file", *(c for c in self.columns if c not in skip and c != "source_file"))

    @property
    def strategy(self) -> str:
        return "MERGE_INSERT" if self.insert_only else "MERGE_DEDUP"


def _fields(**kinds: str) -> tuple[tuple[str, str], ...]:
    return tuple(kinds.items())


_CREATED = (("create_date", "created_at"),)

ORDERS = EntitySpec(
    name="orders",
    key="order_id",
    fields=_fields(
        order_id="long", customer_id="long", order_status="string", order_total_amount="money",
        currency="string", created_at="timestamp", updated_at="timestamp",
    ),
    dates=_CREATED,
    rules=(
        Rule("NEGATIVE_AMOUNT", "negative", "order_total_amount"),
        Rule("MISSING_CUSTOMER", "absent", "customer_id"),
        Rule("MISSING_DATE", "null", "created_at"),
    ),
    hash_parts=(HashPart("order_status"), HashPart("order_total_amount", "0"), HashPart("currency")),
    update=("customer_id", "order_status", "order_total_amount", "currency", "updated_at"),
)

ORDER_ITEMS = EntitySpec(
    name="order_items",
    key="order_item_id",
    fields=_fields(
        order_item_id="long", order_id="long", product_id="long", quantity="long",
        unit_price="money", created_at="timestamp",
    ),
    dates=_CREATED,
    rules=(
        Rule("NEGATIVE_UNIT_PRICE", "negative", "unit_price"),
        Rule("MISSING_PRODUCT", "absent", "product_id"),
        Rule("MISSING_DATE", "null", "created_at"),
    ),
    hash_parts=(HashPart("product_id"), HashPart("quantity"), HashPart("unit_price")),
    newest_by=(),
    update=("product_id", "quantity", "unit_price"),
)

ORDER_STATUS_HISTORY = EntitySpec(
    name="order_status_history",
    key="status_history_id",
    fields=_fields(status_history_id="long", order_id="long", status="string", changed_at="timestamp"),
    rules=(
        Rule("MISSING_ORDER_ID", "absent", "order_id"),
        Rule("MISSING_STATUS", "absent", "status"),
    ),
    newest_by=("changed_at",),
    insert_only=True,
)

PAYMENTS = EntitySpec(
    name="payments",
    key="payment_id",
    fields=_fields(
        payment_id="long", order_id="long", provider="string", payment_status="string",
        amount="money", created_at="timestamp", updated_at="timestamp",
    ),
    dates=_CREATED,
    rules=(
        Rule("MISSING_PAYMENT_STATUS", "absent", "payment_status"),
        Rule("MISSING_PROVIDER", "absent", "provider"),
        Rule("MISSING_DATE", "null", "created_at"),
    ),
    hash_parts=(HashPart("provider"), HashPart("payment_status"), HashPart("amount")),
    update=("order_id", "provider", "payment_status", "amount", "updated_at"),
)

SHIPMENTS = EntitySpec(
    name="shipments",
    key="shipment_id",
    fields=_fields(
        shipment_id="long", order_id="long", carrier="string", shipment_status="string",
        shipped_at="timestamp", delivered_at="timestamp", updated_at="timestamp",
    ),
    dates=(("ship_date", "shipped_at"), ("delivery_date", "delivered_at")),
    rules=(
        Rule("MISSING_CARRIER", "absent", "carrier"),
        Rule("MISSING_SHIPMENT_STATUS", "absent", "shipment_status"),
    ),
    hash_parts=(
        HashPart("carrier"),
        HashPart("shipment_status"),
        HashPart("shipped_at", "1900-01-01", typed=True),
        HashPart("delivered_at", "1900-01-01", typed=True),
    ),
    update=(
        "order_id", "carrier", "shipment_status", "shipped_at", "ship_date", "delivered_at",
        "delivery_date", "updated_at",
    ),
)

PRODUCTS = EntitySpec(
    name="products",
    key="product_id",
    fields=_fields(
        product_id="long", name="string", category="string", brand="string", price="money",
        currency="string", status="string", created_at="timestamp", updated_at="timestamp",
    ),
    dates=_CREATED,
    rules=(
        Rule("NEGATIVE_PRICE", "negative", "price"),
        Rule("EMPTY_NAME", "blank", "name"),
        Rule("MISSING_CURRENCY", "absent", "currency"),
        Rule("MISSING_DATE", "null", "created_at"),
    ),
    hash_parts=(
        HashPart("name"), HashPart("category"), HashPart("brand"), HashPart("price", "0"),
        HashPart("currency"), HashPart("status"),
    ),
    update=("name", "category", "brand", "price", "currency", "status", "updated_at"),
)

CUSTOMERS = EntitySpec(
    name="customers",
    key="customer_id",
    fields=_fields(
        customer_id="long", email="string", first_name="string", last_name="string",
        phone="string", status="string", created_at="timestamp", updated_at="timestamp",
    ),
    dates=_CREATED,
    rules=(
        Rule("INVALID_EMAIL", "not_email", "email"),
        Rule("MISSING_FIRST_NAME", "absent", "first_name"),
        Rule("MISSING_PHONE", "absent", "phone"),
        Rule("MISSING_DATE", "null", "created_at"),
    ),
    hash_parts=(
        HashPart("email"), HashPart("first_name"), HashPart("last_name"), HashPart("phone"),
        HashPart("status"),
    ),
    update=("email", "first_name", "last_name", "phone", "status", "updated_at"),
)

ADDRESSES = EntitySpec(
    name="addresses",
    key="address_id",
    fields=_fields(
        address_id="long", customer_id="long", type="string", street="string", city="string",
        postal_code="string", country="string", is_default="boolean", created_at="timestamp",
        updated_at="timestamp",
    ),
    dates=_CREATED,
    rules=(
        Rule("MISSING_CITY", "absent", "city"),
        Rule("MISSING_STREET", "absent", "street"),
        Rule("MISSING_COUNTRY", "absent", "country"),
        Rule("MISSING_CUSTOMER", "absent", "customer_id"),
        Rule("MISSING_DATE", "null", "created_at"),
    ),
    hash_parts=(
        HashPart("type"), HashPart("street"), HashPart("city"), HashPart("postal_code"),
        HashPart("country"), HashPart("is_default", "false"),
    ),
    update=(
        "customer_id", "type", "street", "city", "postal_code", "country", "is_default", "updated_at",
    ),
)

# Load order: parents before children.
ENTITIES: dict[str, EntitySpec] = {
    s.name: s
    for s in (
        PRODUCTS, CUSTOMERS, ADDRESSES, ORDERS, ORDER_ITEMS, ORDER_STATUS_HISTORY, PAYMENTS, SHIPMENTS,
    )
}


@dataclass(frozen=True)
class IngestEntry:
    """One line of the ingestion configuration."""

    entity: str
    path: str
    is_active: bool = True
    layout: str = "auto"  # "lines" for large JSON lines, which then split inside files


INGESTION: tuple[IngestEntry, ...] = tuple(IngestEntry(s.name, s.path) for s in ENTITIES.values())


UNKNOWN_KEY = -1
BEGIN_OF_TIME = "1900-01-01 00:00:00"
END_OF_TIME = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class DimSpec:
    """A type-2 dimension: versions of ``natural_key`` told apart by ``hash_value``."""

    name: str
    surrogate: str
    natural_key: str
    attributes: tuple[tuple[str, str], ...]
    unknown: dict[str, object] = field(default_factory=dict, hash=False)

    @property
    def columns(self) -> tuple[str, ...]:
        return (
            self.surrogate, self.natural_key, *(a for a, _ in self.attributes),
            "hash_value", "valid_from", "valid_to", "is_current",
        )

    @property
    def schema(self) -> str:
        attrs = ", ".join(f"`{a}` {t}" for a, t in self.attributes)
        return (
            f"{self.surrogate} bigint, {self.natural_key} bigint, {attrs}, hash_value string, "
            "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
        )


DIM_PRODUCTS = DimSpec(
    name="dim_products",
    surrogate="product_key",
    natural_key="product_id",
    attributes=(
        ("name", "string"), ("category", "string"), ("brand", "string"),
        ("price", "decimal(18,2)"), ("currency", "string"), ("status", "string"),
    ),
    unknown={
        "name": "Unknown Product", "category": "Unknown", "brand": "Unknown", "price": 0,
        "currency": "EUR", "status": "Unknown",
    },
)

DIM_CUSTOMERS = DimSpec(
    name="dim_customers",
    surrogate="customer_key",
    natural_key="customer_id",
    attributes=(
        ("email", "string"), ("first_name", "string"), ("last_name", "string"), ("phone", "string"),
        ("city", "string"), ("country", "string"), ("postal_code", "string"), ("street", "string"),
        ("address_type", "string"), ("status", "string"),
    ),
    unknown={
        "email": "Unknown", "first_name": "Unknown", "last_name": "Unknown", "phone": "Unknown",
        "city": "Unknown", "country": "Unknown", "postal_code": "Unknown", "street": "Unknown",
        "address_type": "Unknown", "status": "ACTIVE",
    },
)

DIMENSIONS: dict[str, DimSpec] = {d.name: d for d in (DIM_PRODUCTS, DIM_CUSTOMERS)}


@dataclass(frozen=True)
class FactSpec:
    name: str
    surrogate: str
    key: str
    entity: str
    measures: tuple[tuple[str, str], ...]  # columns after surrogate and key
    update: tuple[str, ...] = ()
    insert_only: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.surrogate, self.key, *(m for m, _ in self.measures), "ingestion_ts")

    @property
    def schema(self) -> str:
        body = ", ".join(f"`{m}` {t}" for m, t in self.measures)
        return f"{self.surrogate} bigint, {self.key} bigint, {body}, ingestion_ts timestamp_ntz"

    @property
    def strategy(self) -> str:
        return "MERGE_INSERT" if self.insert_only else "MERGE_FACT"


_L, _M, _S, _T = "bigint", "decimal(18,2)", "string", "timestamp_ntz"

FACT_ORDERS = FactSpec(
    name="fact_orders",
    surrogate="fact_order_key",
    key="order_id",
    entity="orders",
    measures=(
        ("customer_key", _L), ("order_date_key", _L), ("order_status", _S),
        ("order_total_amount", _M), ("currency", _S), ("created_at", _T), ("updated_at", _T),
    ),
    update=("order_status", "order_total_amount", "currency", "updated_at", "customer_key"),
)

FACT_SALES = FactSpec(
    name="fact_sales",
    surrogate="sales_key",
    key="order_item_id",
    entity="order_items",
    measures=(
        ("order_id", _L), ("product_key", _L), ("customer_key", _L), ("order_date_key", _L),
        ("quantity", _L), ("unit_price", _M), ("total_line_amount", _M), ("currency", _S),
    ),
    update=("product_key", "customer_key", "quantity", "unit_price", "total_line_amount"),
)

FACT_SHIPMENTS = FactSpec(
    name="fact_shipments",
    surrogate="shipment_key",
    key="shipment_id",
    entity="shipments",
    measures=(
        ("order_id", _L), ("customer_key", _L), ("ship_date_key", _L), ("delivery_date_key", _L),
        ("shipped_at", _T), ("delivered_at", _T), ("carrier", _S), ("shipment_status", _S),
        ("days_to_ship", _L), ("days_to_deliver", _L),
    ),
    update=(
        "shipment_status", "ship_date_key", "delivery_date_key", "days_to_ship", "days_to_deliver",
        "customer_key", "shipped_at", "delivered_at",
    ),
)

FACT_PAYMENTS = FactSpec(
    name="fact_payments",
    surrogate="payment_key",
    key="payment_id",
    entity="payments",
    measures=(
        ("order_id", _L), ("customer_key", _L), ("date_key", _L), ("provider", _S),
        ("payment_status", _S), ("amount", _M),
    ),
    update=("payment_status", "amount", "provider", "customer_key"),
)

FACT_ORDER_STATUS_HISTORY = FactSpec(
    name="fact_order_status_history",
    surrogate="history_key",
    key="status_history_id",
    entity="order_status_history",
    measures=(("order_id", _L), ("date_key", _L), ("changed_at_ts", _T), ("status", _S)),
    insert_only=True,
)

FACTS: dict[str, FactSpec] = {
    f.name: f
    for f in (FACT_ORDERS, FACT_SALES, FACT_SHIPMENTS, FACT_PAYMENTS, FACT_ORDER_STATUS_HISTORY)
}

# Column masking.
MASKED_TEXT = "***MASKED***"
PII_COLUMNS = ("email", "phone")
UNMASKED_ROLES = ("ACCOUNTADMIN", "ETL_ROLE")
