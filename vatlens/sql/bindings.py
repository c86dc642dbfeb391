"""DuckDB twins of ``vatlens.sources.bindings`` as CTE text.

Each oracle query is ``WITH <needed bindings> <body>``; the TESTDATA tables
are the pre-registered DuckDB views of the same names.
"""

from __future__ import annotations

N_CUST = "(SELECT count(*) FROM customer)"

LINE_VAT6 = "CAST(l_extendedprice * (1 - l_discount) * l_tax AS DECIMAL(18,6))"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


_cte("b_lines", (), """
SELECT l_orderkey, l_suppkey, l_linenumber, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, o_orderkey, o_custkey, o_orderdate, o_orderstatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

_cte("b_owner_orders", (), f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, partner FROM (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, (o_orderkey * 7 + 3) % {N_CUST} AS partner
  FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey < {N_CUST} * 0.6) t
WHERE partner > o_custkey""")

_cte("arcs", ("b_lines",), f"""
SELECT issuer, receiver, vat FROM (
  SELECT l_suppkey AS issuer, o_custkey AS receiver,
         CAST(round(sum({LINE_VAT6}), 2) AS DECIMAL(18,2)) AS vat
  FROM b_lines WHERE l_suppkey <> o_custkey GROUP BY l_suppkey, o_custkey) t
WHERE vat > 0""")

_cte("communities", (), """
SELECT c_custkey AS id,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END AS community,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE','BUILDING','MACHINERY') THEN 1 ELSE 0 END AS is_company,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE','BUILDING','MACHINERY') THEN 0 ELSE 1 END AS is_natural,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS is_accountant,
       CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS is_rep,
       CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 40 AS INTEGER) END AS initial_group
FROM customer""")

_cte("strength", ("arcs",), """
SELECT issuer, receiver,
       CASE WHEN (issuer + receiver) % 97 = 0 THEN 1.0
            WHEN (issuer * 3 + receiver) % 89 = 0 THEN 0.0
            ELSE round(CAST(vat AS DOUBLE) / CAST(sum(vat) OVER (PARTITION BY receiver) AS DOUBLE), 6)
       END AS fi
FROM arcs""")

_cte("ownership", ("b_owner_orders",), """
SELECT o_custkey AS company, partner,
       CAST(1 + floor(o_totalprice) % 100 AS DOUBLE) AS capital,
       CAST(1 + floor(o_totalprice) % 100 AS DOUBLE) AS profit
FROM b_owner_orders""")

_cte("opacity_seed", ("ownership",), """
SELECT id, (id % 10) / 10.0 AS value FROM (
  SELECT DISTINCT partner AS id FROM ownership WHERE capital <> 0
  EXCEPT
  SELECT DISTINCT company AS id FROM ownership WHERE capital <> 0) t
WHERE id % 11 <> 0""")

_cte("b_kin_base", ("b_owner_orders",), """
SELECT o_orderkey, id, relative,
       CASE WHEN o_orderstatus = 'F' THEN 'SPOUSE' WHEN o_orderstatus = 'O' THEN 'CHILD'
            ELSE 'SIBLING' END AS relation
FROM (SELECT o_orderkey, o_orderstatus, partner AS id,
             lead(partner) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS relative,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
      FROM b_owner_orders) t
WHERE relative IS NOT NULL AND rn % 2 = 1""")

_cte("kinship", ("b_kin_base",), """
SELECT id, relative, relation FROM b_kin_base
UNION ALL SELECT id, id, 'SELF' FROM b_kin_base WHERE o_orderkey % 29 = 0
UNION ALL SELECT relative, id, relation FROM b_kin_base WHERE o_orderkey % 3 = 0
UNION ALL SELECT id, relative, relation FROM b_kin_base WHERE o_orderkey % 5 = 0""")

_cte("groups", (), """
SELECT c_custkey AS id, CAST(c_custkey % 40 AS INTEGER) AS grp FROM customer WHERE c_custkey % 3 = 0
UNION ALL
SELECT c_custkey AS id, CAST(c_custkey % 40 AS INTEGER) AS grp FROM customer WHERE c_custkey % 6 = 0""")

_cte("alerts", (), """
SELECT user_id AS id, code, 'ALERT ' || code AS description,
       CASE WHEN event_id % 2 = 1 THEN ts END AS deactivated,
       CASE WHEN event_id % 3 = 0 THEN 'U' || CAST(event_id % 5 AS VARCHAR) END AS deactivated_by,
       CASE WHEN event_id % 7 = 0 THEN event_id END AS unblock_folio
FROM (SELECT *, CASE WHEN event_id % 9 = 0 THEN '4200' ELSE '411' || CAST(event_id % 4 AS VARCHAR) END AS code
      FROM events WHERE event_type = 'error' AND (user_id % 10 = 3 OR value > 250)) t""")

_cte("invoices", ("b_lines",), f"""
SELECT l_suppkey AS issuer, o_custkey AS receiver,
       CAST(round({LINE_VAT6}, 2) AS DECIMAL(18,2)) AS vat,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS total,
       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS issue_date,
       CASE WHEN l_returnflag = 'R' THEN '61' WHEN l_linestatus = 'O' THEN '33' ELSE '34' END AS doc_code
FROM b_lines""")

_cte("businesses", (), """
SELECT o_custkey AS id, CAST(o_orderkey % 25 AS INTEGER) AS unit, o_orderdate AS valid_from FROM orders""")

_cte("units", (), """
SELECT n_nationkey AS unit, concat_ws(' - ', r_name, n_name) AS region
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")

_cte("taxpayers", (), """
SELECT c_custkey AS id,
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            WHEN c_custkey % 23 = 0 THEN TIMESTAMP '2999-01-01 00:00:00'
            ELSE d END AS start_date
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS d FROM orders GROUP BY o_custkey) f
  ON c_custkey = o_custkey""")

ANNUAL_PERIOD = """CASE WHEN event_id % 11 = 0 THEN 201900 WHEN event_id % 3 = 0 THEN 202000
            WHEN event_id % 3 = 1 THEN 202100 ELSE 202200 END"""

PAYROLL_AMOUNTS = (
    "income_exempt_total", "income_net", "tax_withheld", "extra_withheld", "income_exempt",
    "zone_rebate", "income_m01", "income_m02", "income_m03", "income_m04", "income_m05",
    "income_m06", "income_m07", "income_m08", "income_m09", "income_m10", "income_m11",
    "income_m12",
)

_cte("payroll", (), "SELECT user_id AS id, CAST(user_id % 10 AS VARCHAR) AS dv, "
     + ANNUAL_PERIOD + " AS period, event_id % 37 AS worker, "
     + ", ".join(f"CAST(CAST(value AS DECIMAL(18,2)) * {i + 1} AS DECIMAL(18,2)) AS {n}"
                 for i, n in enumerate(PAYROLL_AMOUNTS))
     + " FROM events WHERE event_type IN ('purchase', 'signup')")

_cte("fees", (), "SELECT user_id AS id, " + ANNUAL_PERIOD
     + " AS period, event_id % 41 AS worker, CAST(value AS DECIMAL(18,2)) AS withheld"
     + " FROM events WHERE event_type IN ('view', 'click')")

_cte("networth", (), """
SELECT o_custkey AS company, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders WHERE o_orderkey % 4 = 0""")

_cte("ledger", ("b_lines",), f"""
SELECT l_orderkey * 10 + l_linenumber AS doc_id,
       CAST(200000 + month(o_orderdate) AS INTEGER) AS period,
       CASE WHEN l_returnflag = 'R' THEN 61 WHEN l_returnflag = 'N' AND l_suppkey % 17 = 0 THEN 30
            ELSE 33 END AS doc_type,
       l_suppkey AS issuer, o_custkey AS receiver,
       CAST(1 + l_linenumber % 7 AS INTEGER) AS tx_type,
       CASE WHEN l_linenumber = 7 THEN 'VENTA' ELSE 'COMPRA' END AS operation,
       CAST(round({LINE_VAT6}, 2) AS DECIMAL(18,2)) AS vat
FROM b_lines""")

DECL_CODES = ("c_77", "c_89", "c_126", "c_160", "c_502", "c_503", "c_504", "c_509", "c_510",
              "c_519", "c_520", "c_525", "c_528", "c_532", "c_535", "c_537", "c_538", "c_553",
              "c_572", "c_704", "c_725", "c_762", "c_766", "c_767", "c_768")


def _m(x, cond=None):
    v = f"CAST(round(inv * {x}, 2) AS DECIMAL(18,2))"
    return f"CASE WHEN {cond} THEN {v} END" if cond else v


def _const(x, cond):
    return f"CASE WHEN {cond} THEN CAST({x} AS DECIMAL(18,2)) END"


_DECL_EXPR = {
    "c_77": f"CASE WHEN id % 3 = 0 THEN {_m('0.1')} ELSE CAST(0 AS DECIMAL(18,2)) END",
    "c_89": _m("0.19"),
    "c_126": _const("0.5", "id % 45 = 0"),
    "c_160": _const("3", "id % 9 = 0"),
    "c_502": _m("1.2"),
    "c_503": "CAST(n_inv AS INTEGER)",
    "c_504": "CASE WHEN id % 2 = 0 THEN CAST((id % 6) * 10 + 5 AS DECIMAL(18,2)) END",
    "c_509": "CAST(n_nc AS INTEGER)",
    "c_510": "CAST(nc AS DECIMAL(18,2))",
    "c_519": "CAST(n_inv AS INTEGER)",
    "c_520": _m("0.9"),
    "c_525": _m("0.02", "id % 5 = 0"),
    "c_528": "CAST(round(nc * 0.8, 2) AS DECIMAL(18,2))",
    "c_532": _const("1.5", "id % 7 = 0"),
    "c_535": _const("0.75", "id % 13 = 0"),
    "c_537": f"CASE WHEN id % 19 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST({_m('1.1')} + 50 AS DECIMAL(18,2)) END",
    "c_538": _m("0.5"),
    "c_553": _const("2.25", "id % 11 = 0"),
    "c_572": _const("2", "id % 36 = 0"),
    "c_704": _const("1", "id % 27 = 0"),
    "c_725": _const("12.5", "id % 9 = 0"),
    "c_762": _m("0.05", "id % 4 = 0"),
    "c_766": _m("0.03", "id % 6 = 0"),
    "c_767": _const("4", "id % 18 = 0"),
    "c_768": _const("6", "id % 9 = 0"),
}


def _decl_select(folio: str, validity: str, override: dict[str, str], where: str) -> str:
    cols = ", ".join(f"{override.get(c, _DECL_EXPR[c])} AS {c}" for c in DECL_CODES)
    return f"SELECT id, {folio} AS folio, period, {validity} AS validity, {cols} FROM b_decl_sums WHERE {where}"


_cte("b_decl_sums", ("ledger",), """
SELECT * FROM (
  SELECT receiver AS id, period,
         sum(CASE WHEN doc_type <> 61 THEN vat ELSE 0 END) AS inv,
         sum(CASE WHEN doc_type = 61 THEN vat ELSE 0 END) AS nc,
         count(CASE WHEN doc_type <> 61 THEN 1 END) AS n_inv,
         count(CASE WHEN doc_type = 61 THEN 1 END) AS n_nc,
         max(doc_id // 10) AS fmax, min(doc_id // 10) AS fmin
  FROM ledger GROUP BY receiver, period) t
WHERE (id * 31 + period) % 10 <> 0""")

_VALID = "CASE WHEN id % 8 = 0 THEN 3 ELSE 1 END"
_cte("declarations", ("b_decl_sums",), "\nUNION ALL\n".join([
    _decl_select("fmax * 10", _VALID, {}, "TRUE"),
    _decl_select("fmin * 10 + 1", _VALID, {"c_520": _m("0.45")}, "fmin < fmax AND id % 4 = 1"),
    _decl_select("fmax * 10 + 2", "2", {"c_537": "CAST(99999 AS DECIMAL(18,2))"}, "id % 10 = 3"),
]))

_cte("observations", (), """
SELECT id, period, code, CAST(amount AS DECIMAL(18,2)) AS amount,
       CASE WHEN emax % 6 = 0 THEN tmax END AS end_date,
       CASE WHEN emin % 10 = 0 THEN 'N' ELSE 'V' END AS status
FROM (SELECT user_id AS id, CAST(200001 + event_id % 12 AS INTEGER) AS period,
             CASE WHEN event_type = 'view' THEN 'FM01' ELSE 'W08' END AS code,
             sum(CAST(value AS DECIMAL(18,2))) AS amount, max(event_id) AS emax,
             min(event_id) AS emin, max(ts) AS tmax
      FROM events WHERE event_type IN ('view', 'click')
      GROUP BY 1, 2, 3) t""")

_cte("authorisations", (), """
SELECT s_suppkey AS id, 'POFE' AS attribute,
       CASE WHEN s_suppkey % 2 = 1 THEN TIMESTAMP '2001-01-01 00:00:00' END AS end_date
FROM supplier WHERE s_suppkey % 2 = 0 OR s_suppkey % 5 = 0
UNION ALL
SELECT s_suppkey, 'OTHR', CAST(NULL AS TIMESTAMP) FROM supplier WHERE s_suppkey % 3 = 0""")


_cte("invoice_points", ("b_lines",), """
SELECT l_suppkey AS issuer, CAST(o_orderkey % 25 AS INTEGER) AS point FROM b_lines""")

_cte("point_regions", (), """
SELECT n_nationkey AS point, r_name AS region FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        for d in CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_inputs(names, body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause holding the named bindings (plus their dependencies)
    followed by ``extra`` (name, sql) CTEs and the final ``body``."""
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in _closure(names)]
    parts += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body if parts else body
