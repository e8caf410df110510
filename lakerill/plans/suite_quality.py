"""Suite: quality rules, reports, failing rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..quality import MONITOR_RULES, TABLE_RULES, Rule, failing_rows, missing_profile, report, score_of_scans, score_over_time, split, summary
from ..session import new_folder
from ..sources import read_table
from ..streaming.quality_scan import SCAN_SCHEMA, read_scans
from .relations import changes, docs, products, sales, with_relations

#: Limits that some of the benchmark's sales break, unlike the standing ones.
STRICT_SALES = (
    Rule("sales", "qty over 45", "invalid_count", "qty", {"max": 45}),
    Rule("sales", "price over 10000", "invalid_count", "price", {"max": 10000.00}),
)
QUARANTINE_SALES = (
    Rule("sales", "qty over 45", "invalid_count", "qty", {"max": 45}),
    Rule("sales", "price over 50000", "invalid_count", "price", {"max": 50000.00}),
)
PLAUSIBLE_VALUE = (Rule("accounts", "value from 0 to 100", "invalid_count", "value", {"above": 0, "max": 100}),)


def _tables(spark, folder) -> dict[str, DataFrame]:
    return {"products": products(spark, folder), "sales": sales(spark, folder)}


def _newest_sale(spark, folder):
    return sales(spark, folder).agg(F.max("sale_ts")).scalar()


def _check(*rules: Rule):
    """A query that reports ``rules`` on the tables they name."""

    def query(spark, folder):
        makers = {"products": products, "sales": sales, "docs": docs}
        tables = {}
        for r in rules:
            for t in (r.table, r.args.get("parent"), r.args.get("values_table")):
                if t and t not in tables:
                    tables[t] = makers[t](spark, folder) if t in makers else read_table(spark, folder, t)
        as_of = _newest_sale(spark, folder) if any(r.filter for r in rules) else None
        return report(tables, rules, as_of)

    return query


def _listed_values(spark, folder):
    """Order numbers of lineitem against those of the orders that are not urgent: valid values that no literal list could hold."""
    lines = read_table(spark, folder, "lineitem").select(F.when(F.col("l_linenumber") < 7, F.col("l_orderkey")).alias("l_orderkey"))
    listed = read_table(spark, folder, "orders").where("o_orderpriority <> '1-URGENT'")
    rule = Rule("lineitem", "order is listed", "invalid_count", "l_orderkey", {"values_table": "listed", "values_column": "o_orderkey"})
    return report({"lineitem": lines, "listed": listed}, [rule])


def _standing_report(spark, folder, rules) -> DataFrame:
    return report(_tables(spark, folder), rules, _newest_sale(spark, folder))


def _failing(spark, folder):
    rows = failing_rows(sales(spark, folder), STRICT_SALES)
    return rows.withColumns({"price": F.col("price").cast("double"), "failed_rules": F.array_join("failed_rules", "; ")})


def _quarantine(spark, folder):
    good, bad = split(sales(spark, folder), QUARANTINE_SALES)

    def measured(df, part):
        totals = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("qty").alias("units"))
        return totals.select(F.lit(part).alias("part"), "n_rows", "units")

    return measured(good, "good").unionAll(measured(bad, "bad"))


#: Rules that look beyond a row: values that occur again, references that lead nowhere.
UNIQUE_SALES = (
    Rule("sales", "one sale per id", "duplicate_count", "id"),
    Rule("sales", "one sale per price", "surplus_count", "price", filter="qty = 7"),
)
LABELLED = (Rule("documents", "label exists", "orphan_count", "doc_id", {"parent": "labels", "parent_column": "doc_id"}),)


def _named(rows):
    return rows.withColumn("failed_rules", F.array_join("failed_rules", "; "))


def _failing_duplicates(spark, folder):
    rows = failing_rows(sales(spark, folder), UNIQUE_SALES, "sales")
    return _named(rows).withColumn("price", F.col("price").cast("double"))


def _failing_orphans(spark, folder):
    documents = read_table(spark, folder, "documents").select("doc_id", "lang")
    return _named(failing_rows(documents, LABELLED, "documents", {"labels": read_table(spark, folder, "labels")}))


def _scan_scores(spark, folder):
    """The standing checks on four days in turn, as stored scans, and the share that passed by day of the scan."""
    tables, newest = _tables(spark, folder), _newest_sale(spark, folder)
    out = new_folder(spark, "scores")
    for i in range(4):
        found = report(tables, MONITOR_RULES, newest + timedelta(days=i)).withColumn(
            "scan_ts", F.lit("2024-01-01 06:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(12 * i))
        )
        found.select(*SCAN_SCHEMA.fieldNames()).coalesce(1).write.parquet(f"{out}/scan={i}")
    return score_of_scans(read_scans(spark, out), "1 day")


QUERIES = {
    "dq_row_count": _check(
        Rule("products", "Row count", "row_count", comparison=">"), Rule("sales", "Row count", "row_count", comparison=">")
    ),
    "dq_missing_count": _check(Rule("docs", "quality is known", "missing_count", "quality")),
    "dq_missing_profile": lambda s, d: missing_profile(docs(s, d)),
    "dq_surplus_duplicates": _check(
        Rule("sales", "surplus ids", "surplus_count", "id"), Rule("docs", "surplus quality", "surplus_count", "quality")
    ),
    "dq_duplicate_count": _check(
        Rule("sales", "repeated ids", "duplicate_count", "id"),
        Rule("docs", "repeated quality", "duplicate_count", "quality"),
    ),
    "dq_invalid_regex": _check(Rule("products", "sku format", "invalid_count", "sku", {"regex": "^P-[0-9]{3}$"})),
    "dq_valid_min": _check(Rule("sales", "qty at least 2", "invalid_count", "qty", {"min": 2})),
    "dq_valid_max": _check(*STRICT_SALES),
    "dq_max_length": _check(Rule("products", "sku length", "invalid_count", "sku", {"max_length": 5})),
    "dq_valid_values_table": _listed_values,
    "dq_valid_values": _check(Rule("sales", "known products", "invalid_count", "product_id", {"values": [1, 2, 3, 4]})),
    "dq_referential_integrity": _check(
        Rule("sales", "product exists", "orphan_count", "product_id", {"parent": "products", "parent_column": "id"}),
        Rule("documents", "label exists", "orphan_count", "doc_id", {"parent": "labels", "parent_column": "doc_id"}),
    ),
    "dq_freshness": _check(
        Rule(
            "sales", "recent sales", "row_count", comparison=">",
            filter="sale_ts >= current_timestamp - interval '24' hour",
        )
    ),
    "dq_custom_metric": _check(
        Rule(
            "sales", "Average order value", "custom", comparison=">", threshold=10.0,
            args={"expr": "cast(sum(price * qty) as double) / count(price * qty)"},
        )
    ),
    "dq_scan_report": lambda s, d: _standing_report(s, d, MONITOR_RULES),
    "dq_rules_report": lambda s, d: _standing_report(s, d, TABLE_RULES),
    "dq_summary": lambda s, d: summary(_standing_report(s, d, MONITOR_RULES)),
    "dq_failing_rows": _failing,
    "dq_failing_duplicates": _failing_duplicates,
    "dq_failing_orphans": _failing_orphans,
    "dq_quarantine_split": _quarantine,
    "dq_score_of_scans": _scan_scores,
    "dq_score_by_day": lambda s, d: score_over_time(changes(s, d), PLAUSIBLE_VALUE, "ts"),
}


def _result_sql(checks: list[tuple[str, str, str, str, float]], *relations: str) -> str:
    """SQL of a report: (table, check name, value query, comparison, threshold) per row."""
    rows = "\nunion all\n".join(
        f"select '{table}' as tbl, '{name}' as check_name, cast(({value}) as double) as value, "
        f"cast({threshold} as double) as threshold, '{comparison}' as cmp"
        for table, name, value, comparison, threshold in checks
    )
    return with_relations(
        f"""with results as ({rows}),
        judged as (select *, case cmp when '=' then value = threshold else value > threshold end as passed from results)
        select tbl as "table", check_name, value, threshold, passed,
            case when passed then 'PASS' else 'FAIL' end as status from judged""",
        *relations,
    )


def _count(table: str, where: str = "true") -> str:
    return f"select count(*) from {table} where {where}"


def _surplus(table: str, column: str) -> str:
    return f"select count(*) - count(distinct {column}) from {table}"


def _repeated(table: str, column: str) -> str:
    return (
        f"select count(*) from (select {column} from {table} where {column} is not null"
        f" group by {column} having count(*) > 1) repeated"
    )


_RECENT = "sale_ts >= (select max(sale_ts) from sales) - interval '24' hour"

_MONITOR = [
    ("products", "Row count", _count("products"), ">", 0),
    ("sales", "Row count", _count("sales"), ">", 0),
    ("products", "Null IDs", _count("products", "id is null"), "=", 0),
    ("products", "Null SKUs", _count("products", "sku is null"), "=", 0),
    ("products", "Duplicate SKUs", _surplus("products", "sku"), "=", 0),
    ("products", "Invalid SKU format", _count("products", "not regexp_matches(sku, '^P-[0-9]{3}$')"), "=", 0),
    ("sales", "Null quantities", _count("sales", "qty is null"), "=", 0),
    ("sales", "Non-positive quantities", _count("sales", "qty <= 0"), "=", 0),
    ("sales", "Null prices", _count("sales", "price is null"), "=", 0),
    ("sales", "Non-positive prices", _count("sales", "price <= 0"), "=", 0),
    ("sales", "Excessive quantities", _count("sales", "qty > 100"), "=", 0),
    ("sales", "Recent sales (24h)", _count("sales", _RECENT), ">", 0),
]

_TABLE = [
    ("products", "Products table has data", _count("products"), ">", 0),
    ("products", "Product ID cannot be null", _count("products", "id is null"), "=", 0),
    ("products", "Product SKU cannot be null", _count("products", "sku is null"), "=", 0),
    ("products", "Product name cannot be null", _count("products", "name is null"), "=", 0),
    ("products", "Product SKU must be unique", _repeated("products", "sku"), "=", 0),
    ("products", "Product ID must be unique", _repeated("products", "id"), "=", 0),
    ("products", "SKU follows correct format (P-XXX)",
     _count("products", "not regexp_matches(sku, '^P-[0-9]{3}$')"), "=", 0),
    ("sales", "Sales table has data", _count("sales"), ">", 0),
    ("sales", "Sale ID cannot be null", _count("sales", "id is null"), "=", 0),
    ("sales", "Product ID reference cannot be null", _count("sales", "product_id is null"), "=", 0),
    ("sales", "Quantity cannot be null", _count("sales", "qty is null"), "=", 0),
    ("sales", "Price cannot be null", _count("sales", "price is null"), "=", 0),
    ("sales", "Sale timestamp cannot be null", _count("sales", "sale_ts is null"), "=", 0),
    ("sales", "Quantity must be positive", _count("sales", "qty < 1"), "=", 0),
    ("sales", "Price must be positive", _count("sales", "price < 0.01"), "=", 0),
    ("sales", "Quantity should be reasonable (max 100)", _count("sales", "qty > 100"), "=", 0),
    ("sales", "Price should be reasonable (max $10,000)", _count("sales", "price > 10000.00"), "=", 0),
    ("sales", "Sale ID must be unique", _repeated("sales", "id"), "=", 0),
    ("sales", "Recent sales exist (within 24 hours)", _count("sales", _RECENT), ">", 0),
    ("sales", "Product ID must reference valid product", _count("sales", "product_id not in (1, 2, 3, 4)"), "=", 0),
]

ORACLE = {
    "dq_row_count": _result_sql(_MONITOR[:2], "products", "sales"),
    "dq_missing_count": _result_sql(
        [("docs", "quality is known", _count("docs", "quality is null"), "=", 0)], "docs"
    ),
    "dq_missing_profile": with_relations(
        "\nunion all\n".join(
            f"select '{c}' as column_name, count(*) - count({c}) as missing from docs"
            for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
        ),
        "docs",
    ),
    "dq_surplus_duplicates": _result_sql(
        [
            ("sales", "surplus ids", _surplus("sales", "id"), "=", 0),
            ("docs", "surplus quality", _surplus("docs", "quality"), "=", 0),
        ],
        "sales", "docs",
    ),
    "dq_duplicate_count": _result_sql(
        [
            ("sales", "repeated ids", _repeated("sales", "id"), "=", 0),
            ("docs", "repeated quality", _repeated("docs", "quality"), "=", 0),
        ],
        "sales", "docs",
    ),
    "dq_invalid_regex": _result_sql(
        [("products", "sku format", _count("products", "not regexp_matches(sku, '^P-[0-9]{3}$')"), "=", 0)], "products"
    ),
    "dq_valid_min": _result_sql([("sales", "qty at least 2", _count("sales", "qty < 2"), "=", 0)], "sales"),
    "dq_valid_max": _result_sql(
        [
            ("sales", "qty over 45", _count("sales", "qty > 45"), "=", 0),
            ("sales", "price over 10000", _count("sales", "price > 10000.00"), "=", 0),
        ],
        "sales",
    ),
    "dq_max_length": _result_sql([("products", "sku length", _count("products", "length(sku) > 5"), "=", 0)], "products"),
    "dq_valid_values_table": _result_sql(
        [(
            "lineitem", "order is listed", _count(
                "lineitem", "l_linenumber < 7 and l_orderkey not in (select o_orderkey from orders where o_orderpriority <> '1-URGENT')"
            ), "=", 0,
        )]
    ),
    "dq_valid_values": _result_sql(
        [("sales", "known products", _count("sales", "product_id not in (1, 2, 3, 4)"), "=", 0)], "sales"
    ),
    "dq_referential_integrity": _result_sql(
        [
            ("sales", "product exists",
             _count("sales s", "product_id is not null and not exists (select 1 from products p where p.id = s.product_id)"),
             "=", 0),
            ("documents", "label exists",
             _count("documents d", "not exists (select 1 from labels l where l.doc_id = d.doc_id)"), "=", 0),
        ],
        "products", "sales",
    ),
    "dq_freshness": _result_sql([("sales", "recent sales", _count("sales", _RECENT), ">", 0)], "sales"),
    "dq_custom_metric": _result_sql(
        [("sales", "Average order value",
          "select cast(sum(price * qty) as double) / count(price * qty) from sales", ">", 10.0)],
        "sales",
    ),
    "dq_scan_report": _result_sql(_MONITOR, "products", "sales"),
    "dq_rules_report": _result_sql(_TABLE, "products", "sales"),
    "dq_failing_rows": with_relations(
        """select id, product_id, qty, cast(price as double) as price, sale_ts,
            concat_ws('; ', case when qty > 45 then 'qty over 45' end,
                case when price > 10000.00 then 'price over 10000' end) as failed_rules
        from sales where qty > 45 or price > 10000.00""",
        "sales",
    ),
    "dq_failing_duplicates": with_relations(
        """select id, product_id, qty, cast(price as double) as price, sale_ts,
            concat_ws('; ', case when n_id > 1 then 'one sale per id' end,
                case when qty = 7 and n_price > 1 then 'one sale per price' end) as failed_rules
        from (select *, count(*) over (partition by id) as n_id,
            count(*) filter (where qty = 7) over (partition by price) as n_price from sales) counted
        where n_id > 1 or qty = 7 and n_price > 1""",
        "sales",
    ),
    "dq_failing_orphans": """select doc_id, lang, 'label exists' as failed_rules from documents
        where doc_id not in (select doc_id from labels)""",
    "dq_quarantine_split": with_relations(
        """select case when qty > 45 or price > 50000.00 then 'bad' else 'good' end as part,
            count(*) as n_rows, cast(sum(qty) as bigint) as units from sales group by 1""",
        "sales",
    ),
    "dq_score_by_day": with_relations(
        """select cast(date_trunc('day', ts) as timestamp) as period,
            count(*) filter (where not (value <= 0 or value > 100)) as ok_rows, count(*) as n_rows,
            count(*) filter (where not (value <= 0 or value > 100)) / count(*) as score from chg group by 1""",
        "chg",
    ),
}
_judged = ORACLE["dq_scan_report"]
ORACLE["dq_summary"] = f"""select count(*) as total, count(*) filter (where passed) as passed,
    count(*) filter (where not passed) as failed,
    coalesce(string_agg("table" || ': ' || check_name, '; ' order by "table" || ': ' || check_name)
        filter (where not passed), '') as failed_checks,
    case when count(*) filter (where not passed) = 0 then 'All data quality checks PASSED'
        else (count(*) filter (where not passed)) || ' checks FAILED' end as verdict
    from ({_judged}) report"""
#: Two scans a day; the first two find recent sales, the others, two days after the newest sale and later, do not.
ORACLE["dq_score_of_scans"] = f"""with others as (
        select count(*) filter (where passed) as p, count(*) as n from ({_judged}) report where check_name <> 'Recent sales (24h)')
    select timestamp '2024-01-01 00:00:00' as period, 2 * (p + 1) as n_passed, 2 * (n + 1) as n_checks,
        cast(p + 1 as double) / (n + 1) as score from others
    union all select timestamp '2024-01-02 00:00:00', 2 * p, 2 * (n + 1), cast(p as double) / (n + 1) from others"""
