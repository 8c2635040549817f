"""The SQL every query must agree with, written for the plain tables.

Rules, merges and lookups are spelled out here on their own, apart from the operators; only the
feeds (test inputs) and the lists of columns are shared.
"""

from __future__ import annotations

from orelode.sources.feeds import FEEDS, LOAD_TS
from orelode.specs import DIM_CUSTOMERS, DIM_PRODUCTS, ENTITIES, FACTS, INGESTION, KINDS

_SQL_TYPES = {"timestamp_ntz": "TIMESTAMP", "string": "VARCHAR", "bigint": "BIGINT",
              "boolean": "BOOLEAN", "decimal(18,2)": "DECIMAL(18,2)"}
_BUCKETS, _BLOCK = 64, 1099511627776

# Columns that a matched row takes over, per table, written out apart from the specs under test.
_UPDATES = {
    "products": (
        "name", "category", "brand", "price", "currency", "status", "updated_at", "hash_value",
        "source_file"
    ),
    "customers": (
        "email", "first_name", "last_name", "phone", "status", "updated_at", "hash_value",
        "source_file"
    ),
    "addresses": (
        "customer_id", "type", "street", "city", "postal_code", "country", "is_default",
        "updated_at", "hash_value", "source_file"
    ),
    "orders": (
        "customer_id", "order_status", "order_total_amount", "currency", "updated_at",
        "hash_value", "source_file"
    ),
    "order_items": ("product_id", "quantity", "unit_price", "hash_value", "source_file"),
    "order_status_history": (),
    "payments": (
        "order_id", "provider", "payment_status", "amount", "updated_at", "hash_value",
        "source_file"
    ),
    "shipments": (
        "order_id", "carrier", "shipment_status", "shipped_at", "ship_date", "delivered_at",
        "delivery_date", "updated_at", "hash_value", "source_file"
    ),
    "fact_orders": (
        "order_status", "order_total_amount", "currency", "updated_at", "customer_key"
    ),
    "fact_sales": (
        "product_key", "customer_key", "quantity", "unit_price", "total_line_amount"
    ),
    "fact_shipments": (
        "shipment_status", "ship_date_key", "delivery_date_key", "days_to_ship",
        "days_to_deliver", "customer_key", "shipped_at", "delivered_at"
    ),
    "fact_payments": ("payment_status", "amount", "provider", "customer_key"),
    "fact_order_status_history": (),
}

# Rejection predicates per entity, first match names the error.
_RULES = {
    "orders": (
        ("order_total_amount < 0", "NEGATIVE_AMOUNT"), ("customer_id IS NULL", "MISSING_CUSTOMER"),
        ("created_at IS NULL", "MISSING_DATE"),
    ),
    "order_items": (
        ("unit_price < 0", "NEGATIVE_UNIT_PRICE"), ("product_id IS NULL", "MISSING_PRODUCT"),
        ("created_at IS NULL", "MISSING_DATE"),
    ),
    "order_status_history": (
        ("order_id IS NULL", "MISSING_ORDER_ID"), ("status IS NULL", "MISSING_STATUS"),
    ),
    "payments": (
        ("payment_status IS NULL", "MISSING_PAYMENT_STATUS"), ("provider IS NULL", "MISSING_PROVIDER"),
        ("created_at IS NULL", "MISSING_DATE"),
    ),
    "shipments": (
        ("carrier IS NULL", "MISSING_CARRIER"), ("shipment_status IS NULL", "MISSING_SHIPMENT_STATUS"),
    ),
    "products": (
        ("price < 0", "NEGATIVE_PRICE"), ("(trim(name) = '' OR name IS NULL)", "EMPTY_NAME"),
        ("currency IS NULL", "MISSING_CURRENCY"), ("created_at IS NULL", "MISSING_DATE"),
    ),
    "customers": (
        ("email NOT LIKE '%@%'", "INVALID_EMAIL"), ("first_name IS NULL", "MISSING_FIRST_NAME"),
        ("phone IS NULL", "MISSING_PHONE"), ("created_at IS NULL", "MISSING_DATE"),
    ),
    "addresses": (
        ("city IS NULL", "MISSING_CITY"), ("street IS NULL", "MISSING_STREET"),
        ("country IS NULL", "MISSING_COUNTRY"), ("customer_id IS NULL", "MISSING_CUSTOMER"),
        ("created_at IS NULL", "MISSING_DATE"),
    ),
}

# Hash inputs as text, in order.
_HASH = {
    "orders": ("order_status:", "order_total_amount:0", "currency:"),
    "order_items": ("product_id:", "quantity:", "unit_price:"),
    "payments": ("provider:", "payment_status:", "amount:"),
    "shipments": ("carrier:", "shipment_status:", "shipped_at:1900-01-01", "delivered_at:1900-01-01"),
    "products": ("name:", "category:", "brand:", "price:0", "currency:", "status:"),
    "customers": ("email:", "first_name:", "last_name:", "phone:", "status:"),
    "addresses": ("type:", "street:", "city:", "postal_code:", "country:", "is_default:false"),
}

_DATES = {
    "orders": {"create_date": "created_at"}, "order_items": {"create_date": "created_at"},
    "payments": {"create_date": "created_at"}, "products": {"create_date": "created_at"},
    "customers": {"create_date": "created_at"}, "addresses": {"create_date": "created_at"},
    "shipments": {"ship_date": "shipped_at", "delivery_date": "delivered_at"},
    "order_status_history": {},
}

_NEWEST = {"order_items": (), "order_status_history": ("changed_at",)}


def _load_ts(batch: int) -> str:
    return f"TIMESTAMP '{LOAD_TS[batch]}'"


def _has_second(e: str) -> bool:
    return any(i.batch == 2 for i in FEEDS[e].images)


class Sql:
    """Common table expressions, each defined once, in the order they were asked for."""

    def __init__(self) -> None:
        self.ctes: dict[str, str] = {}

    def define(self, name: str, sql: str) -> str:
        self.ctes.setdefault(name, sql)
        return name

    def query(self, body: str, money: tuple[str, ...] = (), dates: tuple[str, ...] = ()) -> str:
        casts = [f"CAST({m} AS DOUBLE) AS {m}" for m in money]
        casts += [f"CAST({d} AS VARCHAR) AS {d}" for d in dates]
        star = f"* REPLACE ({', '.join(casts)})" if casts else "*"
        ctes = ",\n".join(f"{n} AS ({s})" for n, s in self.ctes.items())
        head = f"WITH {ctes}\n" if ctes else ""
        return f"{head}SELECT {star} FROM ({body}) AS result"

    # Silver -----------------------------------------------------------------------------------

    def feed(self, e: str) -> str:
        selects = []
        for i in FEEDS[e].images:
            cols = ", ".join(
                f"CAST({i.columns[n].format(ts='TIMESTAMP')} AS {_SQL_TYPES[KINDS[k][1]]}) AS {n}"
                for n, k in ENTITIES[e].fields
            )
            where = f" WHERE {i.where}" if i.where else ""
            selects.append(
                f"SELECT {cols}, '{i.file}' AS source_file, {_load_ts(i.batch)} AS ingestion_ts, "
                f"{i.batch} AS batch_id FROM {FEEDS[e].base}{where}"
            )
        return self.define(f"feed_{e}", " UNION ALL ".join(selects))

    def parsed(self, e: str) -> str:
        extra = [f"CAST({t} AS DATE) AS {d}" for d, t in _DATES[e].items()]
        if e in _HASH:
            parts = []
            for p in _HASH[e]:
                c, default = p.split(":", 1)
                parts.append(f"coalesce(CAST({c} AS VARCHAR), '{default}')")
            extra.append(f"sha256(concat_ws('|', {', '.join(parts)})) AS hash_value")
        cols = "".join(f", {x}" for x in extra)
        return self.define(f"parsed_{e}", f"SELECT *{cols} FROM {self.feed(e)}")

    def tagged(self, e: str) -> str:
        any_rule = " OR ".join(f"({p})" for p, _ in _RULES[e])
        first = " ".join(f"WHEN {p} THEN '{n}'" for p, n in _RULES[e])
        return self.define(
            f"tagged_{e}",
            f"SELECT *, CASE WHEN {any_rule} THEN CASE {first} END "
            f"WHEN NOT ({any_rule}) THEN 'accepted' ELSE 'undecided' END AS verdict FROM {self.parsed(e)}",
        )

    def dedup(self, e: str, batch: int | None = None) -> str:
        spec = ENTITIES[e]
        newest = _NEWEST.get(e, ("updated_at",))
        rest = [c for c in spec.columns if c not in (spec.key, "ingestion_ts", "source_file", *newest)]
        order = ", ".join(
            f"{c} DESC NULLS FIRST" for c in (*newest, "ingestion_ts", "source_file", *rest)
        )
        where = "verdict = 'accepted'" + (f" AND batch_id = {batch}" if batch else "")
        return self.define(
            f"dedup_{e}_{batch or 'all'}",
            f"SELECT {', '.join(spec.columns)} FROM {self.tagged(e)} WHERE {where} "
            f"QUALIFY row_number() OVER (PARTITION BY {spec.key} ORDER BY {order}) = 1",
        )

    def merged(self, name: str, target: str, source: str, key: str, columns, update, gate: str, load: int) -> str:
        """Next state of ``target`` with the action taken per row."""
        act = (
            f"CASE WHEN t.hit IS NULL THEN 'insert' WHEN s.hit IS NOT NULL AND ({gate}) THEN 'update' "
            "ELSE 'keep' END"
        )
        cols = []
        for c in columns:
            if c == "ingestion_ts":
                cols.append(f"CASE WHEN {act} = 'keep' THEN t.{c} ELSE {_load_ts(load)} END AS {c}")
            elif c in update:
                cols.append(f"CASE WHEN {act} = 'keep' THEN t.{c} ELSE s.{c} END AS {c}")
            else:
                cols.append(f"CASE WHEN {act} = 'insert' THEN s.{c} ELSE t.{c} END AS {c}")
        return self.define(
            name,
            f"SELECT {', '.join(cols)}, {act} AS _action FROM (SELECT *, 1 AS hit FROM {target}) t "
            f"FULL JOIN (SELECT *, 1 AS hit FROM {source}) s ON t.{key} = s.{key}",
        )

    def silver(self, e: str, through: int = 2) -> str:
        spec = ENTITIES[e]
        cols = ", ".join(c for c in spec.columns if c != "ingestion_ts")
        first = self.define(
            f"silver_{e}_1",
            f"SELECT {cols}, {_load_ts(1)} AS ingestion_ts, 'insert' AS _action FROM {self.dedup(e, 1)}",
        )
        if through == 1 or not _has_second(e):
            return first
        update = _UPDATES[e]
        gate = "false" if e == "order_status_history" else "s.hash_value <> t.hash_value"
        return self.merged(
            f"silver_{e}_2", first, self.dedup(e, 2), spec.key, spec.columns, update, gate, 2
        )

    def changes(self, e: str, load: int) -> str:
        if load == 1:
            return self.silver(e, 1)
        return self.define(
            f"changes_{e}_2", f"SELECT * FROM {self.silver(e)} WHERE _action <> 'keep'"
        )

    # Gold -------------------------------------------------------------------------------------

    @staticmethod
    def key(key: str, load: int, more: str = "") -> str:
        mixed = f"((({key} % 2147483647) * 1583458089) % 2147483647)"
        bucket = f"coalesce(({mixed} * {_BUCKETS}) // 2147483647, 0)"
        order = f"{key} NULLS FIRST{more}"
        return (
            f"CAST({(load - 1) * _BLOCK} + (row_number() OVER (PARTITION BY {bucket} ORDER BY {order}) - 1)"
            f" * {_BUCKETS} + {bucket} + 1 AS BIGINT)"
        )

    def changed_ids(self, load: int) -> str:
        return self.define(
            f"changed_ids_{load}",
            f"SELECT customer_id FROM {self.changes('customers', load)} UNION "
            f"SELECT customer_id FROM {self.changes('addresses', load)}",
        )

    def dim_source(self, dim: str, load: int) -> str:
        if dim == "dim_products":
            return self.define(
                f"src_products_{load}",
                "SELECT product_id, name, category, brand, price, currency, status, hash_value, "
                f"updated_at AS valid_from FROM {self.changes('products', load)}",
            )
        parts = ("c.email", "c.first_name", "c.last_name", "c.phone", "c.status", "a.city", "a.country",
                 "a.postal_code", "a.street", "a.type")
        hashed = ", ".join(f"coalesce({p}, '')" for p in parts)
        ids = self.changed_ids(load)
        return self.define(
            f"src_customers_{load}",
            "SELECT c.customer_id, c.email, c.first_name, c.last_name, c.phone, c.status, "
            "coalesce(a.city, 'Unknown') AS city, coalesce(a.country, 'Unknown') AS country, "
            "coalesce(a.postal_code, 'Unknown') AS postal_code, coalesce(a.street, 'Unknown') AS street, "
            f"coalesce(a.type, 'Unknown') AS address_type, sha256(concat_ws('|', {hashed})) AS hash_value, "
            f"{_load_ts(load)} AS valid_from FROM {self.silver('customers', load)} c "
            f"JOIN {ids} i ON c.customer_id = i.customer_id "
            f"LEFT JOIN {self.silver('addresses', load)} a ON c.customer_id = a.customer_id AND a.is_default",
        )

    def dim(self, spec, through: int = 2, mode: str = "versioned") -> str:
        cols = list(spec.columns)
        values = []
        for c in cols:
            if c in (spec.surrogate, spec.natural_key):
                values.append(f"CAST(-1 AS BIGINT) AS {c}")
            elif c == "hash_value":
                values.append("'0' AS hash_value")
            elif c == "valid_from":
                values.append("TIMESTAMP '1900-01-01 00:00:00' AS valid_from")
            elif c == "valid_to":
                values.append("TIMESTAMP '9999-12-31 00:00:00' AS valid_to")
            elif c == "is_current":
                values.append("true AS is_current")
            elif c == "price":
                values.append("CAST(0 AS DECIMAL(18,2)) AS price")
            else:
                values.append(f"'{spec.unknown[c]}' AS {c}")
        state = self.define(f"{spec.name}_0", f"SELECT {', '.join(values)}")
        for load in range(1, through + 1):
            src = self.define(
                f"{spec.name}_src_{load}",
                f"SELECT *, {self.key(spec.natural_key, load, ', hash_value NULLS FIRST')} AS new_key "
                f"FROM {self.dim_source(spec.name, load)}",
            )
            k = spec.natural_key
            old = ", ".join(
                "CASE WHEN s.hash_value <> t.hash_value THEN s.valid_from ELSE t.valid_to END AS valid_to"
                if c == "valid_to"
                else "CASE WHEN s.hash_value <> t.hash_value THEN false ELSE t.is_current END AS is_current"
                if c == "is_current"
                else f"t.{c}"
                for c in cols
            )
            opened = ", ".join(
                f"s.new_key AS {c}" if c == spec.surrogate
                else "TIMESTAMP '9999-12-31 00:00:00' AS valid_to" if c == "valid_to"
                else "true AS is_current" if c == "is_current"
                else f"s.{c}"
                for c in cols
            )
            reopen = " OR s.hash_value <> t.hash_value" if mode == "versioned" else ""
            state = self.define(
                f"{spec.name}_{mode}_{load}",
                f"SELECT {old} FROM {state} t LEFT JOIN {src} s ON t.{k} = s.{k} AND t.is_current "
                f"UNION ALL SELECT {opened} FROM {src} s LEFT JOIN {state} t "
                f"ON t.{k} = s.{k} AND t.is_current WHERE t.{k} IS NULL{reopen}",
            )
        return state

    def dim_state(self, spec, state: str) -> str:
        k = spec.natural_key
        cols = ", ".join(
            f"s.{c}" for c in spec.columns if c not in (spec.surrogate, "valid_to", "is_current")
        )
        src, dim = self.dim_source(spec.name, 2), self.dim(spec, 1)
        if state == "new":
            return (
                f"SELECT {cols} FROM {src} s LEFT JOIN {dim} t ON s.{k} = t.{k} AND t.is_current "
                f"WHERE t.{k} IS NULL"
            )
        return (
            f"SELECT {cols} FROM {src} s JOIN {dim} t ON s.{k} = t.{k} AND t.is_current "
            "WHERE s.hash_value <> t.hash_value"
        )

    def fact_source(self, name: str, load: int, dims: int = 2) -> str:
        spec = FACTS[name]
        ch = self.changes(spec.entity, load)
        ymd = "CAST(strftime({}, '%Y%m%d') AS BIGINT)"

        def customer(key: str, at: str) -> str:
            dim = self.dim(DIM_CUSTOMERS, dims)
            return (
                f"LEFT JOIN {dim} dc ON {key} = dc.customer_id AND {at} >= dc.valid_from "
                f"AND {at} < dc.valid_to"
            )

        if name == "fact_orders":
            body = (
                "SELECT x.order_id, coalesce(dc.customer_key, -1) AS customer_key, "
                f"{ymd.format('x.create_date')} AS order_date_key, x.order_status, x.order_total_amount, "
                f"x.currency, x.created_at, x.updated_at FROM {ch} x {customer('x.customer_id', 'x.created_at')}"
            )
        elif name == "fact_order_status_history":
            body = (
                f"SELECT status_history_id, order_id, {ymd.format('changed_at')} AS date_key, "
                f"changed_at AS changed_at_ts, status FROM {ch}"
            )
        else:
            orders = f"LEFT JOIN {self.silver('orders', load)} o ON x.order_id = o.order_id"
            if name == "fact_sales":
                dp = self.dim(DIM_PRODUCTS, dims)
                body = (
                    "SELECT x.order_item_id, x.order_id, coalesce(dp.product_key, -1) AS product_key, "
                    "coalesce(dc.customer_key, -1) AS customer_key, "
                    f"{ymd.format('x.create_date')} AS order_date_key, x.quantity, x.unit_price, "
                    "CAST(x.quantity * x.unit_price AS DECIMAL(18,2)) AS total_line_amount, o.currency "
                    f"FROM {ch} x {orders} LEFT JOIN {dp} dp ON x.product_id = dp.product_id "
                    "AND x.created_at >= dp.valid_from AND x.created_at < dp.valid_to "
                    f"{customer('o.customer_id', 'o.created_at')}"
                )
            elif name == "fact_shipments":
                body = (
                    "SELECT x.shipment_id, x.order_id, coalesce(dc.customer_key, -1) AS customer_key, "
                    f"coalesce({ymd.format('x.ship_date')}, -1) AS ship_date_key, "
                    f"coalesce({ymd.format('x.delivery_date')}, -1) AS delivery_date_key, "
                    "x.shipped_at, x.delivered_at, x.carrier, x.shipment_status, "
                    "datediff('day', o.created_at, x.shipped_at) AS days_to_ship, "
                    "datediff('day', x.shipped_at, x.delivered_at) AS days_to_deliver "
                    f"FROM {ch} x {orders} {customer('o.customer_id', 'x.updated_at')}"
                )
            else:
                body = (
                    "SELECT x.payment_id, x.order_id, coalesce(dc.customer_key, -1) AS customer_key, "
                    f"{ymd.format('x.create_date')} AS date_key, x.provider, x.payment_status, x.amount "
                    f"FROM {ch} x {orders} {customer('o.customer_id', 'x.created_at')}"
                )
        return self.define(
            f"src_{name}_{load}_{dims}",
            f"SELECT *, {self.key(spec.key, load)} AS {spec.surrogate} FROM ({body}) AS q",
        )

    def fact(self, name: str, dims_by_load: tuple[int, int] = (1, 2)) -> str:
        spec = FACTS[name]
        cols = ", ".join(c for c in spec.columns if c != "ingestion_ts")
        tag = "".join(map(str, dims_by_load))
        first = self.define(
            f"{name}_1_{tag}",
            f"SELECT {cols}, {_load_ts(1)} AS ingestion_ts, 'insert' AS _action "
            f"FROM {self.fact_source(name, 1, dims_by_load[0])}",
        )
        if not _has_second(spec.entity):
            return first
        return self.merged(
            f"{name}_2_{tag}", first, self.fact_source(name, 2, dims_by_load[1]), spec.key,
            spec.columns, _UPDATES[name], "false" if name == "fact_order_status_history" else "true", 2,
        )


def _entity_casts(e: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    money = tuple(n for n, k in ENTITIES[e].fields if k == "money")
    return money, tuple(_DATES[e])


def _fact_money(name: str) -> tuple[str, ...]:
    return tuple(m for m, t in FACTS[name].measures if t.startswith("decimal"))


def _silver_oracles() -> dict[str, str]:
    out = {}
    for e, spec in ENTITIES.items():
        money, dates = _entity_casts(e)
        q = Sql()
        out[f"silver_{e}_typed"] = q.query(
            f"SELECT {', '.join(spec.columns)} FROM {q.parsed(e)}", money, dates
        )
        q = Sql()
        out[f"dq_{e}"] = q.query(f"SELECT verdict, count(*) AS n FROM {q.tagged(e)} GROUP BY verdict")
        q = Sql()
        out[f"dedup_{e}"] = q.query(f"SELECT * FROM {q.dedup(e)}", money, dates)
        q = Sql()
        out[f"silver_merge_{e}"] = q.query(f"SELECT * FROM {q.silver(e)}", money, dates)
    q = Sql()
    out["dq_undecided"] = q.query(" UNION ALL ".join(
        f"SELECT '{e}' AS entity, count(*) FILTER (WHERE verdict = 'undecided') AS undecided, "
        f"count(*) FILTER (WHERE verdict = 'undecided') AS strict_unknown FROM {q.tagged(e)}"
        for e in ENTITIES
    ))
    q = Sql()
    rule = "(order_total_amount < 0) OR (customer_id IS NULL AND order_id % 2 <> 0) OR created_at IS NULL"
    out["dq_json_null_vs_missing"] = q.query(
        "SELECT CASE WHEN order_id % 2 = 0 THEN 'json null' ELSE 'missing' END AS form, "
        f"CASE WHEN {rule} THEN CASE WHEN order_total_amount < 0 THEN 'NEGATIVE_AMOUNT' "
        "WHEN customer_id IS NULL AND order_id % 2 <> 0 THEN 'MISSING_CUSTOMER' ELSE 'MISSING_DATE' END "
        f"WHEN NOT ({rule}) THEN 'accepted' ELSE 'undecided' END AS verdict, count(*) AS n "
        f"FROM {q.feed('orders')} GROUP BY 1, 2"
    )
    out["dq_payments_negative"] = (
        "SELECT CASE WHEN CAST(c_acctbal AS DECIMAL(18,2)) < 0 THEN 'NEGATIVE_PAYMENT' "
        "WHEN c_custkey % 13 = 0 THEN 'MISSING_PAYMENT_STATUS' ELSE 'accepted' END AS verdict, "
        "count(*) AS n FROM customer GROUP BY 1"
    )
    q = Sql()
    checks = (
        ("order_items", "orders", "order_id", "ORPHAN_ORDER"),
        ("order_items", "products", "product_id", "ORPHAN_PRODUCT"),
        ("orders", "customers", "customer_id", "ORPHAN_CUSTOMER"),
        ("payments", "orders", "order_id", "ORPHAN_ORDER"),
        ("shipments", "orders", "order_id", "ORPHAN_ORDER"),
        ("addresses", "customers", "customer_id", "ORPHAN_CUSTOMER"),
    )
    out["dq_orphans"] = q.query(" UNION ALL ".join(
        f"SELECT '{err}' AS error_type, '{c}' AS entity, count(*) AS n FROM {q.silver(c)} x "
        f"WHERE x.{k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {q.silver(p)} y WHERE y.{k} = x.{k}) "
        "HAVING count(*) > 0"
        for c, p, k, err in checks
    ))
    return out


def _bronze_oracles() -> dict[str, str]:
    out = {}
    q = Sql()
    out["bronze_scan"] = q.query(
        "SELECT order_id, order_status, CAST(order_total_amount AS VARCHAR) AS order_total_amount, "
        f"true AS has_file FROM {q.feed('orders')}"
    )
    q = Sql()
    out["bronze_bad_records"] = q.query(
        f"SELECT order_id % 50 IN (0, 1, 2, 3) AS is_bad, count(*) AS n FROM {q.feed('orders')} GROUP BY 1"
    )
    q = Sql()
    out["bronze_scan_array"] = q.query(
        f"SELECT form, count(*) AS n, sum(order_id) AS ids, count(DISTINCT order_id) AS orders FROM "
        f"{q.feed('orders')}, (VALUES ('one line'), ('indented'), ('lines')) f(form) GROUP BY form"
    )
    # Streets went with their addresses; a third of the profiles changed after that.
    out["incremental_moved_addresses"] = (
        "SELECT c_custkey AS customer_id, '+1' AS phone, concat(CAST(c_custkey AS VARCHAR), ' Main St') AS street, "
        "c_custkey % 3 <> 0 AS is_current FROM customer UNION ALL "
        "SELECT c_custkey, '+2', 'Unknown', true FROM customer WHERE c_custkey % 3 = 0"
    )
    out["scd2_products_late"] = (
        "SELECT p_partkey AS product_id, v.name, CAST(v.valid_from AS TIMESTAMP) AS valid_from, "
        "CAST(v.valid_to AS TIMESTAMP) AS valid_to FROM part, (VALUES "
        "('first', '1995-01-01 00:00:00', '1995-03-01 00:00:00'), "
        "('second', '1995-03-01 00:00:00', '9999-12-31 00:00:00')) v(name, valid_from, valid_to)"
    )
    q = Sql()
    out["bronze_incremental"] = q.query(
        f"SELECT ingestion_ts, count(*) AS n FROM {q.feed('orders')} GROUP BY 1"
    )
    q = Sql()
    out["bronze_config_active"] = q.query(" UNION ALL ".join(
        f"SELECT '{i.entity}' AS entity, '{i.path}' AS path, count(*) AS rows_landed FROM {q.feed(i.entity)}"
        for i in INGESTION if i.is_active
    ))
    q = Sql()
    out["bronze_file_manifest"] = q.query(" UNION ALL ".join(
        f"SELECT '{e}' AS entity, source_file, count(*) AS rows_loaded FROM {q.feed(e)} GROUP BY source_file"
        for e in ENTITIES
    ))
    return out


def _gold_oracles() -> dict[str, str]:
    out = {}
    q = Sql()
    d = "CAST(CAST('2000-01-01' AS DATE) + CAST(i AS INTEGER) AS DATE)"
    days = q.define(
        "days",
        f"SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS date_value, day(d) AS day_num, "
        "dayname(d) AS day_name, left(dayname(d), 3) AS day_name_short, isodow(d) AS day_of_week, "
        "dayofyear(d) AS day_of_year, weekofyear(d) AS week_of_year, month(d) AS month_num, "
        "monthname(d) AS month_name, left(monthname(d), 3) AS month_name_short, quarter(d) AS quarter, "
        "year(d) AS year, strftime(d, '%Y-%m') AS year_month, isodow(d) IN (6, 7) AS is_weekend, "
        "d = last_day(d) AS is_last_day_of_month, datediff('day', DATE '1970-01-01', d) AS epoch_days "
        f"FROM (SELECT {d} AS d FROM range(20000) r(i)) AS g",
    )
    out["dim_date"] = q.query(
        "SELECT p.*, days.* FROM (SELECT CAST(strftime(created_at, '%Y%m%d') AS BIGINT) AS order_date_key, "
        f"count(*) AS orders FROM {q.feed('orders')} GROUP BY 1) p "
        f"FULL JOIN {days} ON p.order_date_key = days.date_key",
        dates=("date_value",),
    )
    q = Sql()
    out["unknown_members"] = q.query(
        f"SELECT d.*, s.lines, s.amount FROM {q.dim(DIM_PRODUCTS)} d LEFT JOIN (SELECT product_key, "
        f"count(*) AS lines, sum(total_line_amount) AS amount FROM {q.fact('fact_sales')} "
        "GROUP BY product_key) s ON d.product_key = s.product_key WHERE d.product_key = -1",
        money=("price", "amount"),
    )
    for spec, name in ((DIM_PRODUCTS, "products"), (DIM_CUSTOMERS, "customers")):
        money = ("price",) if spec is DIM_PRODUCTS else ()
        for state in ("new", "changed"):
            q = Sql()
            out[f"dim_{name}_{state}"] = q.query(q.dim_state(spec, state), money)
        for mode, suffix in (("versioned", ""), ("close_only", "_close_only")):
            q = Sql()
            out[f"scd2_{name}{suffix}"] = q.query(f"SELECT * FROM {q.dim(spec, 2, mode)}", money)
    q = Sql()
    out["dim_customers_source"] = q.query(f"SELECT * FROM {q.dim_source('dim_customers', 2)}")
    q = Sql()
    out["changed_customer_ids"] = q.query(f"SELECT * FROM {q.changed_ids(2)}")
    q = Sql()
    new, changed = q.dim_state(DIM_PRODUCTS, "new"), q.dim_state(DIM_PRODUCTS, "changed")
    out["scd2_source_literal"] = q.query(
        f"SELECT product_id, hash_value, valid_from, CAST(NULL AS BIGINT) AS join_key FROM ({new}) AS n "
        f"UNION ALL SELECT product_id, hash_value, valid_from, product_id AS join_key FROM ({changed}) AS c"
    )
    q = Sql()
    out["pit_lookup"] = q.query(
        "SELECT coalesce(d.product_key, -1) AS product_key, count(*) AS items, "
        f"CAST(sum(x.quantity) AS BIGINT) AS units FROM {q.feed('order_items')} x "
        f"LEFT JOIN {q.dim(DIM_PRODUCTS)} d ON x.product_id = d.product_id "
        "AND x.created_at >= d.valid_from AND x.created_at < d.valid_to GROUP BY 1"
    )
    for name in FACTS:
        q = Sql()
        out[name] = q.query(f"SELECT * FROM {q.fact(name)}", _fact_money(name))
    q = Sql()
    out["surrogate_keys"] = q.query(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, CAST(floor(({k} - 1) / {_BLOCK}.0) AS BIGINT) AS load_no, "
        f"count(*) AS row_count, count(DISTINCT {k}) AS distinct_keys, min({k}) AS min_key, "
        f"max({k}) AS max_key FROM {t} GROUP BY 2"
        for n, k, t in (
            ("dim_products", "product_key", q.dim(DIM_PRODUCTS)),
            ("dim_customers", "customer_key", q.dim(DIM_CUSTOMERS)),
            ("fact_orders", "fact_order_key", q.fact("fact_orders")),
        )
    ))
    q = Sql()
    out["merge_source_duplicates"] = q.query(
        f"SELECT order_item_id, count(*) AS n FROM {q.feed('order_items')} GROUP BY 1 HAVING count(*) > 1"
    )
    q = Sql()
    views = {"v_dim_customers": q.dim(DIM_CUSTOMERS), "v_dim_products": q.dim(DIM_PRODUCTS)}
    views |= {f"v_{f}": q.fact(f) for f in FACTS}
    out["gold_views"] = q.query(" UNION ALL ".join(
        f"SELECT '{v}' AS view_name, count(*) AS n FROM {t}" for v, t in views.items()
    ))
    q = Sql()
    silver = q.silver("customers")
    out["masked_customers"] = q.query(
        "SELECT customer_id, '***MASKED***' AS email, '***MASKED***' AS phone, last_name, "
        f"'ANALYST' AS role_name FROM {silver} UNION ALL "
        f"SELECT customer_id, email, phone, last_name, 'ETL_ROLE' FROM {silver}"
    )
    q = Sql()
    out["kpi_revenue_by_month"] = q.query(
        "SELECT f.order_date_key // 100 AS month_key, d.category, sum(f.total_line_amount) AS revenue, "
        "CAST(sum(f.quantity) AS BIGINT) AS units, count(*) AS lines "
        f"FROM {q.fact('fact_sales')} f LEFT JOIN {q.dim(DIM_PRODUCTS)} d ON f.product_key = d.product_key "
        "GROUP BY 1, 2",
        money=("revenue",),
    )
    q = Sql()
    out["kpi_shipping"] = q.query(
        "SELECT carrier, shipment_status, count(*) AS shipments, "
        "CAST(sum(days_to_ship) AS BIGINT) AS sum_days_to_ship, "
        "CAST(sum(days_to_deliver) AS BIGINT) AS sum_days_to_deliver, "
        "round(avg(days_to_ship), 4) AS avg_days_to_ship, "
        "round(avg(days_to_deliver), 4) AS avg_days_to_deliver "
        f"FROM {q.fact('fact_shipments')} GROUP BY 1, 2"
    )
    q = Sql()
    out["kpi_orders_by_status"] = q.query(
        "SELECT order_status, currency, count(*) AS orders, sum(order_total_amount) AS amount "
        f"FROM {q.fact('fact_orders')} GROUP BY 1, 2",
        money=("amount",),
    )
    return out


def _load_oracles() -> dict[str, str]:
    out = {}
    money, dates = _entity_casts("orders")
    q = Sql()
    second = q.silver("orders")
    out["change_feed_net"] = q.query(
        f"SELECT *, CASE WHEN ingestion_ts = {_load_ts(2)} THEN 1 ELSE 0 END AS _batch_id "
        f"FROM (SELECT * REPLACE (CASE _action WHEN 'keep' THEN 'insert' ELSE _action END AS _action) "
        f"FROM {second}) AS s",
        money, dates,
    )
    for name in ("stream_silver_orders", "stream_retry_idempotent", "merge_pruned_buckets"):
        q = Sql()
        out[name] = q.query(
            f"SELECT s.* EXCLUDE (_action), e.dq_errors FROM {q.silver('orders')} s LEFT JOIN "
            f"(SELECT order_id, count(*) AS dq_errors FROM {q.tagged('orders')} "
            "WHERE verdict NOT IN ('accepted', 'undecided') GROUP BY order_id) e ON s.order_id = e.order_id",
            money, dates,
        )
    q = Sql()
    parts = []
    for e, last in [(e, b) for e in ENTITIES for b in ((1, 2) if _has_second(e) else (1,))]:
        ch = q.changes(e, last)
        parts.append(
            f"SELECT '{e}' AS entity, {last} AS batch, count(*) AS read, "
            "count(*) FILTER (WHERE verdict NOT IN ('accepted', 'undecided')) AS rejected, "
            "count(*) FILTER (WHERE verdict = 'accepted') AS accepted, "
            "count(*) FILTER (WHERE verdict = 'undecided') AS undecided, "
            f"(SELECT count(*) FROM {ch} WHERE _action = 'insert') AS inserted, "
            f"(SELECT count(*) FROM {ch} WHERE _action = 'update') AS updated "
            f"FROM {q.tagged(e)} WHERE batch_id = {last}"
        )
    out["audit_counts"] = q.query(" UNION ALL ".join(parts))
    q = Sql()
    parts = []
    for e in ENTITIES:
        parts.append(
            f"SELECT 'silver.{e}' AS table_name, count(*) AS n, CAST(NULL AS BIGINT) AS known FROM {q.silver(e)}"
        )
        parts.append(
            f"SELECT 'dq_errors.{e}', count(*), NULL FROM {q.tagged(e)} "
            "WHERE verdict NOT IN ('accepted', 'undecided')"
        )
    for spec in (DIM_PRODUCTS, DIM_CUSTOMERS):
        parts.append(
            f"SELECT 'gold.{spec.name}', count(*), count(*) FILTER (WHERE is_current) FROM {q.dim(spec)}"
        )
    for f in FACTS:
        known = "NULL" if f == "fact_order_status_history" else "count(*) FILTER (WHERE customer_key <> -1)"
        parts.append(f"SELECT 'gold.{f}', count(*), {known} FROM {q.fact(f, (1, 2))}")
    out["medallion_end_to_end"] = q.query(" UNION ALL ".join(parts))
    return out


def _order_states(q: Sql) -> tuple[str, str, str]:
    """The orders after each of three batches; the third takes some back and deletes some."""
    shown = "order_id, order_status, order_total_amount, currency"
    first, second = q.silver("orders", 1), q.silver("orders")
    q.define("orders_1", f"SELECT {shown} FROM {first}")
    q.define("orders_2", f"SELECT {shown} FROM {second}")
    q.define(
        "orders_3",
        "SELECT * FROM orders_1 WHERE order_id % 14 = 0 AND order_id % 15 <> 0 AND order_id % 97 <> 0 UNION ALL "
        "SELECT * FROM orders_2 WHERE order_id % 15 <> 0 AND order_id % 97 <> 0 "
        "AND NOT (order_id % 14 = 0 AND order_id IN (SELECT order_id FROM orders_1))",
    )
    return "orders_1", "orders_2", "orders_3"


def _history_oracles() -> dict[str, str]:
    out = {}
    q = Sql()
    out["bronze_scan_split_array"] = q.query(
        "SELECT CASE WHEN good THEN order_id END AS order_id, CASE WHEN good THEN order_status END AS order_status, "
        "CASE WHEN good THEN CAST(order_total_amount AS VARCHAR) END AS order_total_amount, "
        "CASE WHEN good THEN 'a \"quoted\" } brace { \\' END AS note "
        f"FROM (SELECT *, order_id % 50 <> 0 AS good FROM {q.feed('orders')}) AS f"
    )
    q = Sql()
    one, _, three = _order_states(q)
    out["change_feed_images"] = q.query(
        "SELECT coalesce(a.order_id, b.order_id) AS order_id, CASE WHEN a.order_id IS NULL THEN 'insert' "
        "WHEN b.order_id IS NULL THEN 'delete' ELSE 'update' END AS _action, a.order_status AS before_order_status, "
        "a.order_total_amount AS before_order_total_amount, b.order_status AS after_order_status, "
        f"b.order_total_amount AS after_order_total_amount FROM {one} a FULL JOIN {three} b ON a.order_id = b.order_id "
        "WHERE a.order_id IS NULL OR b.order_id IS NULL OR (a.order_status, a.order_total_amount, a.currency) "
        "IS DISTINCT FROM (b.order_status, b.order_total_amount, b.currency)",
        ("before_order_total_amount", "after_order_total_amount"),
    )
    q = Sql()
    out["kpi_incremental"] = q.query(
        " UNION ALL ".join(
            f"SELECT order_status, currency, count(*) AS rows, sum(order_total_amount) AS order_total_amount, {n} AS batch "
            f"FROM {state} GROUP BY 1, 2"
            for n, state in enumerate(_order_states(q), 1)
        ),
        ("order_total_amount",),
    )
    q = Sql()
    items, orders = q.silver("order_items", 1), q.silver("orders", 1)
    out["dq_orphans_redrive"] = q.query(
        "SELECT i.order_item_id, i.order_id, CASE WHEN i.order_id IS NULL THEN 1 WHEN o.order_id IS NULL THEN NULL "
        f"WHEN o.order_id % 2 = 0 THEN 2 ELSE 1 END AS load FROM {items} i LEFT JOIN {orders} o ON i.order_id = o.order_id"
    )
    out["pit_lookup_long_history"] = (
        "WITH prices AS (SELECT l_suppkey AS supplier, l_shipdate AS since, "
        "max((l_extendedprice, l_orderkey)) AS v FROM lineitem GROUP BY 1, 2), "
        "spans AS (SELECT *, lead(since) OVER (PARTITION BY supplier ORDER BY since) AS until FROM prices), "
        "facts AS (SELECT l_orderkey AS order_id, l_linenumber AS line, "
        "CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS supplier, l_shipdate + to_days(l_linenumber - 4) AS at FROM lineitem) "
        "SELECT f.*, v[1] AS price, v[2] AS price_order FROM facts f LEFT JOIN spans s ON f.supplier = s.supplier "
        "AND f.at >= s.since AND (f.at < s.until OR s.until IS NULL)"
    )
    return out


def _reload_oracles() -> dict[str, str]:
    out = {}
    q = Sql()
    out["bronze_reload_changed"] = q.query(
        f"SELECT ingestion_ts, count(*) AS n, count(DISTINCT order_id) AS orders FROM {q.feed('orders')} GROUP BY 1"
    )
    q = Sql()
    first, second = q.silver("orders", 1), q.changes("orders", 2)
    late = q.define(
        "late_orders",
        f"SELECT order_id FROM {second} WHERE order_id IS NULL "
        f"OR order_id NOT IN (SELECT order_id FROM {first} WHERE order_id IS NOT NULL)",
    )
    keys = q.define(
        "order_keys",
        f"SELECT order_id, row_number() OVER (ORDER BY order_id NULLS FIRST) AS fact_order_key FROM {first} UNION ALL "
        f"SELECT order_id, (SELECT count(*) FROM {first}) + row_number() OVER (ORDER BY order_id NULLS FIRST) FROM {late}",
    )
    out["surrogate_keys_dense"] = q.query(
        f"SELECT k.fact_order_key, k.order_id, s.order_status FROM {keys} k "
        f"LEFT JOIN {q.silver('orders')} s ON k.order_id = s.order_id"
    )
    q = Sql()
    silver = q.silver("customers")
    out["masked_by_session_role"] = q.query(
        "SELECT customer_id, CASE WHEN role_name = 'ETL_ROLE' THEN email ELSE '***MASKED***' END AS email, "
        "CASE WHEN role_name = 'ETL_ROLE' THEN phone ELSE '***MASKED***' END AS phone, last_name, role_name "
        f"FROM {silver} CROSS JOIN (VALUES ('ANALYST'), ('ETL_ROLE')) AS r(role_name)"
    )
    return out


def all_oracles() -> dict[str, str]:
    return (
        _bronze_oracles() | _silver_oracles() | _gold_oracles() | _load_oracles() | _history_oracles()
        | _reload_oracles()
    )
