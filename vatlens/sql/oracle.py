"""DuckDB SQL twins, one per registered query (see ``vatlens.plans.registry``).

Written independently of the DataFrame code from the definitions in SURVEY section 2;
loops are recursive CTEs, or chains of CTEs built by small text helpers.
"""

from __future__ import annotations

from vatlens.sql.bindings import with_inputs

ORACLE: dict[str, str] = {}


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"({dbl(a)} / NULLIF({dbl(b)}, 0))"


# ---------------------------------------------------------------- 2.7 flows
TAGGED = ("tagged", """
SELECT a.issuer, c1.community AS issuer_community, a.receiver, c2.community AS receiver_community, a.vat
FROM arcs a
LEFT JOIN communities c1 ON a.issuer = c1.id
LEFT JOIN communities c2 ON a.receiver = c2.id
WHERE a.vat > 0 AND (c1.community IS NOT NULL OR c2.community IS NOT NULL)""")

# every arc seen from both of its ends, summed into cells (end, community, side, relation)
CELLS = ("cells", """
SELECT who, own, side, CASE WHEN own = other THEN 'intra' WHEN own <> other THEN 'extra' ELSE 'open' END AS relation,
  sum(vat) AS vat, count(*) AS arcs
FROM (SELECT issuer AS who, issuer_community AS own, receiver_community AS other, 'issued' AS side, vat FROM tagged
      UNION ALL SELECT receiver, receiver_community, issuer_community, 'received', vat FROM tagged) ends
GROUP BY ALL""")


def _cell(measure: str, side: str, relation: str) -> str:
    return f"sum({measure}) FILTER (WHERE side = '{side}' AND relation = '{relation}')"


def _of_taxpayer(side: str, counts_if_absent: str) -> str:
    """The four columns of one side; the counts of a taxpayer without arcs there are ``counts_if_absent``."""
    vat = [f"COALESCE({_cell('vat', side, x)}, 0) AS vat_{x}_{side}" for x in ("intra", "extra")]
    arcs = [f"CASE WHEN count(*) FILTER (WHERE side = '{side}') > 0 THEN COALESCE({_cell('arcs', side, x)}, 0)::BIGINT "
            f"ELSE {counts_if_absent} END AS arcs_{x}_{side}" for x in ("intra", "extra")]
    return ", ".join(vat + arcs)


FLOW_ISSUER = ("flow_i", f"SELECT who AS issuer, {_of_taxpayer('issued', '0')} FROM cells WHERE side = 'issued' GROUP BY who")
FLOW_RECEIVER = ("flow_r", f"SELECT who AS receiver, {_of_taxpayer('received', '0')} FROM cells WHERE side = 'received' GROUP BY who")
TAXPAYER_FLOW = ("tflow", f"SELECT who AS taxpayer, {_of_taxpayer('issued', 'NULL')}, {_of_taxpayer('received', 'NULL')} "
                 "FROM cells GROUP BY who")
COMMUNITY_FLOW = ("cflow", "SELECT own AS com, "
                  + ", ".join(f"{_cell('vat', s, x)} AS {s}_{x}, {_cell('arcs', s, x)}::BIGINT AS arcs_{s}_{x}"
                              for s in ("issued", "received") for x in ("intra", "extra"))
                  + " FROM cells WHERE relation <> 'open' GROUP BY own")
COMMUNITY_RATIOS = ("cratios", "SELECT *, "
                    + ", ".join(f"100 * {div(f'{s}_extra', f'({s}_intra + {s}_extra)')} AS pct_{s}_extra" for s in ("issued", "received"))
                    + f", {div('issued_extra', 'issued_intra')} AS rate_issued_extra_intra FROM cflow")

FLOW_IN = ["arcs", "communities"]


def _money(cols):
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


ORACLE["arcs_tagged"] = with_inputs(
    FLOW_IN, "SELECT issuer, issuer_community, receiver, receiver_community, CAST(vat AS DOUBLE) AS vat FROM tagged",
    [TAGGED])

ORACLE["flow_issuer"] = with_inputs(
    FLOW_IN, "SELECT issuer, " + _money(["vat_intra_issued", "vat_extra_issued"])
    + ", arcs_intra_issued, arcs_extra_issued FROM flow_i", [TAGGED, CELLS, FLOW_ISSUER])

ORACLE["flow_receiver"] = with_inputs(
    FLOW_IN, "SELECT receiver, " + _money(["vat_intra_received", "vat_extra_received"])
    + ", arcs_intra_received, arcs_extra_received FROM flow_r", [TAGGED, CELLS, FLOW_RECEIVER])

FLOW_MONEY = ["vat_intra_issued", "vat_extra_issued", "vat_intra_received", "vat_extra_received"]

ORACLE["taxpayer_flow"] = with_inputs(
    FLOW_IN, "SELECT taxpayer, " + _money(FLOW_MONEY[:2]) + ", arcs_intra_issued, arcs_extra_issued, "
    + _money(FLOW_MONEY[2:]) + ", arcs_intra_received, arcs_extra_received FROM tflow",
    [TAGGED, CELLS, TAXPAYER_FLOW])

CF_MONEY = ["issued_intra", "issued_extra", "received_intra", "received_extra"]
CF_COUNTS = ["arcs_issued_intra", "arcs_issued_extra", "arcs_received_intra", "arcs_received_extra"]

ORACLE["community_flow"] = with_inputs(
    FLOW_IN, "SELECT com, " + _money(CF_MONEY) + ", " + ", ".join(CF_COUNTS) + " FROM cflow",
    [TAGGED, CELLS, COMMUNITY_FLOW])

RATIO_COLS = ("com, pct_issued_extra, pct_received_extra, " + _money(CF_MONEY)
              + ", rate_issued_extra_intra, " + ", ".join(CF_COUNTS))

ORACLE["community_ratios"] = with_inputs(
    FLOW_IN, f"SELECT {RATIO_COLS} FROM cratios", [TAGGED, CELLS, COMMUNITY_FLOW, COMMUNITY_RATIOS])

ORACLE["community_size"] = with_inputs(
    FLOW_IN, f"SELECT {RATIO_COLS.replace('com,', 'r.com,', 1)}, s.community_size FROM cratios r "
    "LEFT JOIN (SELECT community AS com, count(*) AS community_size FROM communities GROUP BY community) s "
    "ON r.com = s.com", [TAGGED, CELLS, COMMUNITY_FLOW, COMMUNITY_RATIOS])

ORACLE["networth"] = with_inputs(
    ["networth"], "SELECT company, CAST(sum(amount) AS DOUBLE) AS networth FROM networth GROUP BY company")

# ---------------------------------------------------------------- 2.8 views
LOOKUP_KEY = "replace(' 1 2 ', ' ', '')"



def money_text(c: str) -> str:
    return f"COALESCE('$' || format('{{:,.0f}}', {dbl(c)}), '')"


ORACLE["money_format"] = with_inputs(
    FLOW_IN, "SELECT taxpayer, " + ", ".join(f"{money_text(c)} AS {c}" for c in FLOW_MONEY) + " FROM tflow",
    [TAGGED, CELLS, TAXPAYER_FLOW])


def _shares(pairs):
    out = []
    for name, (a, b) in pairs.items():
        out.append(f"{div(a, f'{a} + {b}')} * 100 AS pct_intra_{name}")
        out.append(f"{div(b, f'{a} + {b}')} * 100 AS pct_extra_{name}")
    return ", ".join(out)


ORACLE["intra_extra_share"] = with_inputs(
    FLOW_IN, "SELECT taxpayer, " + _money(FLOW_MONEY) + ", " + _shares({
        "issued": ("vat_intra_issued", "vat_extra_issued"),
        "received": ("vat_intra_received", "vat_extra_received")}) + " FROM tflow",
    [TAGGED, CELLS, TAXPAYER_FLOW])

ORACLE["intra_extra_share_community"] = with_inputs(
    FLOW_IN, "SELECT com, " + _money(CF_MONEY) + ", " + _shares({
        "issued": ("issued_intra", "issued_extra"),
        "received": ("received_intra", "received_extra")}) + " FROM cflow",
    [TAGGED, CELLS, COMMUNITY_FLOW])


def r(x: str, d: int = 9) -> str:
    return f"round({x}, {d})"


def chain(prefix: str, first: int, last: int, make) -> list[tuple[str, str]]:
    """CTEs ``prefix{i}`` for i in first..last, each built by ``make(i)``."""
    return [(f"{prefix}{i}", make(i)) for i in range(first, last + 1)]


# ------------------------------------------------------- 2.1 ownership/opacity
OCLEAN = ("oclean", "SELECT DISTINCT company, partner, capital, profit FROM ownership WHERE capital <> 0")
OAVG = ("oavg", "SELECT company, partner, avg(capital) AS capital, avg(profit) AS profit FROM oclean GROUP BY company, partner")

_G1 = "(SELECT company, partner, capital, profit, count(*) AS c FROM ownership GROUP BY company, partner, capital, profit)"
ORACLE["own_profile"] = with_inputs(["ownership"], f"""
SELECT count(*) AS rows,
  count(*) FILTER (WHERE capital IS NULL OR profit IS NULL) AS null_shares,
  count(*) FILTER (WHERE capital = 0 OR profit = 0) AS zero_either,
  count(*) FILTER (WHERE capital = 0 AND profit = 0) AS zero_both,
  count(*) FILTER (WHERE capital = 0 AND profit <> 0) AS zero_capital_only,
  count(*) FILTER (WHERE capital <> 0 AND profit = 0) AS zero_profit_only,
  count(*) FILTER (WHERE capital < 0 OR capital > 100 OR profit < 0 OR profit > 100) AS out_of_range,
  count(*) FILTER (WHERE capital <> 0) AS nonzero_capital,
  (SELECT count(*) FROM {_G1} g WHERE c > 1) AS duplicated_rows,
  (SELECT CAST(COALESCE(sum(c - 1), 0) AS BIGINT) FROM {_G1} g) AS surplus_copies,
  (SELECT count(*) FROM (SELECT company, partner, count(*) AS c FROM ownership GROUP BY company, partner) p
   WHERE c > 1) AS repeated_pairs
FROM ownership""")

ORACLE["own_company_totals"] = with_inputs(
    ["ownership"], "SELECT company, sum(capital) AS capital, sum(profit) AS profit FROM oclean GROUP BY company",
    [OCLEAN])
ORACLE["own_clean"] = with_inputs(["ownership"], "SELECT * FROM oclean", [OCLEAN])
ORACLE["own_avg_share"] = with_inputs(
    ["ownership"], f"SELECT company, partner, {r('capital')} AS capital, {r('profit')} AS profit FROM oavg",
    [OCLEAN, OAVG])
ORACLE["own_weight"] = with_inputs(
    ["ownership"], f"SELECT company, {r('sum(capital)')} AS total_capital, {r('sum(profit)')} AS total_profit "
    "FROM oavg GROUP BY company", [OCLEAN, OAVG])

SEEDED = ("seeded", "SELECT a.company, a.partner, a.capital, s.value FROM oavg a "
          "LEFT JOIN opacity_seed s ON a.partner = s.id")


def _resolve_sql(src: str) -> str:
    return (f"SELECT company, sum(capital * value * 0.01) / NULLIF(sum(capital), 0) * 100 AS value "
            f"FROM {src} GROUP BY company HAVING count(*) = count(value)")


#: All rounds until one adds nothing; the last holds every resolved company.
RESOLVED = ("opres", f"""
WITH RECURSIVE rounds AS (
  SELECT 0 AS round, company, value, 0 AS iteration, TRUE AS fresh FROM res0
  UNION ALL
  SELECT x.round, x.company, x.value, coalesce(o.iteration, x.round), o.company IS NULL
  FROM (SELECT (SELECT max(round) FROM rounds) + 1 AS round, company,
               sum(capital * value * 0.01) / NULLIF(sum(capital), 0) * 100 AS value
        FROM (SELECT s.company, s.capital, coalesce(s.value, q.value) AS value FROM seeded s LEFT JOIN rounds q ON s.partner = q.company)
        GROUP BY company HAVING count(*) = count(value)) x
  LEFT JOIN rounds o ON o.company = x.company
  WHERE EXISTS (SELECT 1 FROM rounds WHERE fresh))
SELECT company, value, iteration FROM rounds WHERE round = (SELECT max(round) FROM rounds)""")
OPACITY_CTES = [OCLEAN, OAVG, SEEDED, ("res0", _resolve_sql("seeded")), RESOLVED]
OPACITY_IN = ["ownership", "opacity_seed"]

ORACLE["opacity_level0"] = with_inputs(
    OPACITY_IN, f"SELECT company, {r('value')} AS value FROM res0", OPACITY_CTES[:4])
ORACLE["opacity_propagate"] = with_inputs(
    OPACITY_IN, f"SELECT company, {r('value')} AS value FROM opres", OPACITY_CTES)
ORACLE["opacity_first_iter"] = with_inputs(OPACITY_IN, "SELECT company, iteration FROM opres", OPACITY_CTES)
ORACLE["opacity_filled_mesh"] = with_inputs(
    OPACITY_IN, f"SELECT s.company, s.partner, {r('s.capital')} AS capital, {r('coalesce(s.value, q.value)')} AS value "
    "FROM seeded s LEFT JOIN opres q ON s.partner = q.company", OPACITY_CTES)
ORACLE["opacity_summary"] = with_inputs(
    OPACITY_IN, f"SELECT count(value) AS count, {r('avg(value)', 6)} AS mean, {r('stddev_samp(value)', 6)} AS std, "
    f"{r('min(value)', 6)} AS min, {r('quantile_cont(value, 0.25)', 6)} AS q25, {r('quantile_cont(value, 0.5)', 6)} AS q50, "
    f"{r('quantile_cont(value, 0.75)', 6)} AS q75, {r('max(value)', 6)} AS max FROM opres", OPACITY_CTES)

ORACLE["opacity_quartiles"] = with_inputs(
    OPACITY_IN, f"SELECT {r('quantile_cont(value, 0.25)', 6)} AS q25, {r('quantile_cont(value, 0.5)', 6)} AS q50, "
    f"{r('quantile_cont(value, 0.75)', 6)} AS q75 FROM opres", OPACITY_CTES)

# ------------------------------------------------------------- 2.2 kinship
#: Rounds of replacing an owner that is a company by its own owners.
OWNER_ROUNDS = 9
KIN_CTES = [OCLEAN, ("leaf", f"""
WITH RECURSIVE walk AS (
  SELECT company, partner AS owner, count(*)::HUGEINT AS paths, 0 AS depth FROM oclean GROUP BY company, partner
  UNION ALL
  SELECT w.company, o.partner, sum(w.paths)::HUGEINT, w.depth + 1 FROM walk w JOIN oclean o ON o.company = w.owner
  WHERE w.depth < {OWNER_ROUNDS} GROUP BY w.company, o.partner, w.depth)
SELECT company, owner, sum(paths)::HUGEINT AS paths FROM walk
WHERE depth = {OWNER_ROUNDS} OR owner IS NULL OR owner NOT IN (SELECT company FROM oclean) GROUP BY company, owner"""),
    ("person", "SELECT DISTINCT id FROM opacity_seed"),
    ("holder", "SELECT l.*, p.id AS natural_id FROM leaf l LEFT JOIN person p ON p.id = l.owner"),
    ("complete", "SELECT company, sum(paths)::HUGEINT AS total, (sum(paths) FILTER (WHERE natural_id IS NOT NULL))::HUGEINT AS matched "
                 "FROM holder GROUP BY company"),
    ("elig", "SELECT company, natural_id AS owner, paths FROM holder WHERE company IN "
             "(SELECT company FROM complete WHERE total = matched)"),
    ("kedges", "SELECT DISTINCT unnest([id, relative]) AS id, unnest([relative, id]) AS relative FROM kinship WHERE id <> relative"),
    # from the kin edges to companies that both ends own
    ("kmatch", "SELECT a.company, e.id AS owner, e.relative FROM kedges e JOIN elig a ON a.owner = e.id "
               "SEMI JOIN elig b ON b.owner = e.relative AND b.company = a.company"),
    ("krate", f"SELECT c.company, count(DISTINCT k.owner) AS kin_owners, c.total, {div('count(DISTINCT k.owner)', 'c.total')} * 100 "
              "AS kinship_rate FROM complete c LEFT JOIN kmatch k USING (company) GROUP BY c.company, c.total"),
]
KIN_IN = ["ownership", "opacity_seed", "kinship"]

ORACLE["owners_expand"] = with_inputs(
    ["ownership"], "SELECT company, owner, paths::DOUBLE AS paths, (owner IN (SELECT company FROM oclean))::INT AS is_company FROM leaf", KIN_CTES[:2])
ORACLE["owners_natural"] = with_inputs(
    KIN_IN, "SELECT company, owner, paths::DOUBLE AS paths, natural_id FROM holder",
    KIN_CTES)
ORACLE["companies_per_person"] = with_inputs(
    KIN_IN, "SELECT natural_id AS person, sum(paths)::DOUBLE AS n_companies FROM holder WHERE natural_id IS NOT NULL "
    "GROUP BY natural_id", KIN_CTES)
ORACLE["owners_completeness"] = with_inputs(KIN_IN, "SELECT company, total::DOUBLE AS total, matched::DOUBLE AS matched FROM complete", KIN_CTES)
ORACLE["owners_eligible"] = with_inputs(
    KIN_IN, "SELECT company, owner, paths::DOUBLE AS paths FROM elig", KIN_CTES)
ORACLE["partner_pairs"] = with_inputs(
    KIN_IN, "SELECT a.company, sum(a.paths * b.paths)::DOUBLE AS n_pairs FROM elig a JOIN elig b "
    "ON b.company = a.company AND b.owner <> a.owner GROUP BY a.company", KIN_CTES)
ORACLE["kin_edges"] = with_inputs(KIN_IN, "SELECT id, relative FROM kedges", KIN_CTES)
ORACLE["kin_type_counts"] = with_inputs(
    ["kinship"], "SELECT relation, count(*) AS n FROM kinship GROUP BY ROLLUP (relation)")
ORACLE["kin_matches"] = with_inputs(KIN_IN, "SELECT company, owner, relative FROM kmatch", KIN_CTES)
ORACLE["kinship_rate"] = with_inputs(
    KIN_IN, f"SELECT company, kin_owners, total::DOUBLE AS total, {r('kinship_rate')} AS kinship_rate FROM krate", KIN_CTES)
ORACLE["group_coverage"] = with_inputs(
    ["ownership", "groups"], "SELECT count(*) AS matches FROM (SELECT DISTINCT id, grp FROM groups) g "
    "JOIN oclean m ON g.id = m.company", [OCLEAN])

# ------------------------------------------------------- 2.3 contamination
SEED_WHERE = "code IN ('4110', '4111', '4112') OR code = '4113' AND deactivated IS NULL"
SEEDS = ("seeds", f"SELECT DISTINCT id, 1 AS score FROM alerts WHERE {SEED_WHERE}")
#: Rounds of the contamination model.
CON_ROUNDS = 15
FZ = [
    ("pulled", "SELECT issuer, receiver, fi, sum(fi) OVER w AS sfi, "
               "COALESCE(exp(sum(ln(abs(1 - fi))) FILTER (WHERE fi <> 1) OVER w), 0) AS f0 "
               "FROM strength WHERE fi > 0 WINDOW w AS (PARTITION BY receiver)"),
    ("fz", "SELECT issuer, receiver, fi, f0, CASE WHEN pull <> 0 THEN pull / sfi ELSE pull END AS f "
           "FROM (SELECT *, round((1 - f0) * fi, 4) AS pull FROM pulled) p"),
    ("nodes", "SELECT DISTINCT unnest([issuer, receiver]) AS id FROM fz"),
    SEEDS,
    ("con0", "SELECT id, (id IN (SELECT id FROM seeds))::INT::DOUBLE AS score FROM nodes"),
]
CON_CTES = FZ + [
    # what flows into a node each round: issuers' scores, its own times f0, and its score as it stands
    ("moves", "SELECT issuer AS src, receiver AS dst, f AS weight, true AS renews FROM fz "
              "UNION ALL SELECT receiver, receiver, max(f0), true FROM fz GROUP BY receiver "
              "UNION ALL SELECT id, id, 1.0, false FROM nodes"),
    ("con", f"""WITH RECURSIVE spread AS (
  SELECT id, score, 0 AS round_no FROM con0
  UNION ALL
  SELECT m.dst, greatest(max(s.score) FILTER (WHERE NOT m.renews), sum(m.weight * s.score) FILTER (WHERE m.renews)), s.round_no + 1
  FROM spread s JOIN moves m ON m.src = s.id WHERE s.round_no < {CON_ROUNDS} GROUP BY m.dst, s.round_no)
SELECT id, score FROM spread WHERE round_no = {CON_ROUNDS}"""),
]
CON_IN = ["strength", "alerts"]

ORACLE["alert_seeds"] = with_inputs(["alerts"], "SELECT id, score FROM seeds", [SEEDS])
ORACLE["alert_profile"] = with_inputs(
    ["alerts"], f"SELECT id, count(*) AS n_alerts FROM alerts WHERE {SEED_WHERE} GROUP BY id")
ORACLE["alert_descriptions"] = with_inputs(
    ["alerts"], f"SELECT DISTINCT description FROM alerts WHERE {SEED_WHERE}")
ORACLE["edge_strength"] = with_inputs(
    CON_IN, f"SELECT issuer, receiver, {r('fi')} AS fi, {r('f0')} AS f0, {r('f')} AS f FROM fz", FZ[:2])
ORACLE["trade_nodes"] = with_inputs(CON_IN, "SELECT id FROM nodes", FZ[:3])
ORACLE["contam_init"] = with_inputs(CON_IN, "SELECT id, score FROM con0", FZ)
ORACLE["contam_propagate"] = with_inputs(CON_IN, f"SELECT id, {r('score')} AS score FROM con", CON_CTES)

# ------------------------------------------------------- 2.4 / 2.5 labels
SINCE = "TIMESTAMP '2000-06-01 00:00:00'"
TODAY = "TIMESTAMP '2001-12-31 00:00:00'"
PAID = ("paid", "SELECT id, sum(c_89) AS paid_total FROM declarations WHERE validity = 1 AND "
        f"strptime(CAST(period AS VARCHAR) || '01', '%Y%m%d') >= {SINCE} GROUP BY id")
VATNET = ("vnet", """
SELECT id, sum(issued) AS vat_issued, sum(received) AS vat_received, sum(received) - sum(issued) AS vat_net
FROM (SELECT issuer AS id, COALESCE(vat, 0) AS issued, 0 AS received FROM inv
      UNION ALL SELECT receiver, 0, COALESCE(vat, 0) FROM inv) ends GROUP BY id""")
INV = ("inv", "SELECT * FROM invoices WHERE doc_code IN ('33', '34') AND "
       f"strptime(CAST(issue_date AS VARCHAR), '%Y%m%d') >= {SINCE}")
REGION = ("lregion", "SELECT id, region, valid_from FROM (SELECT b.id, u.region, b.valid_from, row_number() OVER "
          "(PARTITION BY b.id ORDER BY b.valid_from DESC, b.unit ASC) AS rn FROM businesses b "
          "LEFT JOIN units u ON b.unit = u.unit) t WHERE rn = 1")
DOCS = ("docs", "SELECT issuer AS id, count(*) AS n_documents FROM invoices WHERE doc_code IN ('33', '34') GROUP BY issuer")
LIFE = ("life", f"SELECT id, CASE WHEN start_date IS NULL OR start_date > {TODAY} THEN NULL "
        f"ELSE datediff('day', start_date, {TODAY}) END AS lifetime FROM taxpayers")

ORACLE["paid_total"] = with_inputs(["declarations"], "SELECT id, CAST(paid_total AS DOUBLE) AS paid_total FROM paid", [PAID])
ORACLE["vat_net"] = with_inputs(
    ["invoices"], "SELECT id, " + _money(["vat_issued", "vat_received", "vat_net"]) + " FROM vnet", [INV, VATNET])
ORACLE["latest_region"] = with_inputs(["businesses", "units"], "SELECT * FROM lregion", [REGION])
ORACLE["docs_issued"] = with_inputs(["invoices"], "SELECT * FROM docs", [DOCS])
ORACLE["lifetime_days"] = with_inputs(["taxpayers"], "SELECT * FROM life", [LIFE])
ORACLE["initial_alert_flag"] = with_inputs(
    CON_IN, "SELECT id, (id IN (SELECT id FROM seeds))::INT AS initial_alert FROM nodes", FZ[:4])
ORACLE["contam_labels"] = with_inputs(
    CON_IN + ["declarations", "invoices", "businesses", "units", "taxpayers"], f"""
SELECT c.id, {r('c.score')} AS score, CAST(p.paid_total AS DOUBLE) AS paid_total, CAST(v.vat_net AS DOUBLE) AS vat_net,
       g.region, d.n_documents, l.lifetime, CASE WHEN s.id IS NULL THEN 0 ELSE 1 END AS initial_alert
FROM con c
LEFT JOIN paid p ON c.id = p.id
LEFT JOIN vnet v ON c.id = v.id
LEFT JOIN lregion g ON c.id = g.id
LEFT JOIN docs d ON c.id = d.id
LEFT JOIN life l ON c.id = l.id
LEFT JOIN (SELECT DISTINCT id FROM seeds) s ON c.id = s.id""", CON_CTES + [PAID, INV, VATNET, REGION, DOCS, LIFE])

PAYROLL_AMOUNTS = (
    "income_exempt_total", "income_net", "tax_withheld", "extra_withheld", "income_exempt",
    "zone_rebate", "income_m01", "income_m02", "income_m03", "income_m04", "income_m05",
    "income_m06", "income_m07", "income_m08", "income_m09", "income_m10", "income_m11",
    "income_m12",
)
PP = ("pp", "SELECT id, dv, period, count(DISTINCT worker) AS dependent_workers, "
      + ", ".join(f"sum({a}) AS {a}" for a in PAYROLL_AMOUNTS)
      + " FROM payroll WHERE period IN (202000, 202100, 202200) GROUP BY id, dv, period")
PL = ("pl", "SELECT id, dv, period, dependent_workers FROM (SELECT *, row_number() OVER "
      "(PARTITION BY id, dv ORDER BY period DESC) AS rn FROM pp) t WHERE rn = 1")
FW = ("fw", "SELECT id, period, count(DISTINCT worker) AS fee_workers, sum(withheld) AS fee_total FROM fees "
      "WHERE period BETWEEN 202000 AND 202200 GROUP BY id, period")
FL = ("fl", "SELECT id, period, fee_workers FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY period DESC) "
      "AS rn FROM fw) t WHERE rn = 1")

ORACLE["payroll_period"] = with_inputs(
    ["payroll"], "SELECT id, dv, period, dependent_workers, " + _money(PAYROLL_AMOUNTS) + " FROM pp", [PP])
ORACLE["payroll_latest"] = with_inputs(["payroll"], "SELECT * FROM pl", [PP, PL])
ORACLE["fee_workers"] = with_inputs(
    ["fees"], "SELECT id, period, fee_workers, CAST(fee_total AS DOUBLE) AS fee_total FROM fw", [FW])
ORACLE["fee_latest"] = with_inputs(["fees"], "SELECT * FROM fl", [FW, FL])
ORACLE["workers_last"] = with_inputs(
    ["payroll", "fees"], "SELECT COALESCE(f.id, p.id) AS id, COALESCE(f.fee_workers, 0) AS fee_workers, "
    "COALESCE(p.dependent_workers, 0) AS dependent_workers FROM fl f FULL OUTER JOIN "
    "(SELECT id, max(dependent_workers) AS dependent_workers FROM pl GROUP BY id) p ON f.id = p.id",
    [PP, PL, FW, FL])

# ------------------------------------------------------- 2.6 credit tracing
from vatlens.sql import credit_sql as cs  # noqa: E402

P1 = 200006
#: The periods of the ledger, in order.
PERIODS = range(200001, 200013)


def _chain(periods) -> list[tuple[str, str]]:
    """Relations m<period>_<name> of each period, on top of the one before it."""
    out = cs.base()
    for p in periods:
        out += cs.period_ctes(p, f"m{p}_", None if p == PERIODS[0] else f"m{p - 1}_totals")
    return out


ALL = _chain(PERIODS)
#: One period on top of the periods before it.
A = _chain(range(PERIODS[0], P1)) + cs.period_ctes(P1, "a_", f"m{cs.prior(P1)}_totals")
CIN = cs.CREDIT_INPUTS


def _cr(body, ctes=A):
    return with_inputs(CIN, body, ctes)


def _every(cols, name, periods=PERIODS):
    """Rows of relation ``name`` of all periods."""
    return " UNION ALL ".join(f"SELECT {cols} FROM m{p}_{name}" for p in periods)


ORACLE["periods"] = with_inputs(["ledger"], """
SELECT DISTINCT period FROM ledger WHERE period IN (
  SELECT CAST(strftime(e + to_months(CAST(i AS INTEGER)), '%Y%m') AS INTEGER)
  FROM (SELECT date_trunc('month', s - INTERVAL 365 DAY) AS e, s
        FROM (SELECT CAST(date_trunc('month', DATE '2001-01-15') AS DATE) AS s) q) b, range(1, 40) t(i)
  WHERE e + to_months(CAST(i AS INTEGER)) < s)""")
ORACLE["prior_period"] = with_inputs(["declarations"], """
SELECT DISTINCT period, CASE WHEN period % 100 = 1 THEN (period // 100 - 1) * 100 + 12 ELSE period - 1 END AS prior
FROM declarations""")
_NOW = f"WHERE period = {P1}"
ORACLE["decl_latest"] = _cr(f"SELECT folio AS max_folio, id, period FROM filed {_NOW}")
ORACLE["decl_prior"] = _cr(f"SELECT * FROM carryover WHERE period_ant = {cs.prior(P1)}")
ORACLE["decl_current"] = _cr(f"SELECT * FROM claims {_NOW}")
ORACLE["observations"] = _cr(f"SELECT id, period, amount, code FROM notes {_NOW}")
ORACLE["decl_adjust_fm01"] = _cr(f"SELECT * FROM adjusted {_NOW}")
ORACLE["carry_in"] = _cr("SELECT * FROM a_carry")
ORACLE["ledger_docs"] = _cr(f"SELECT * FROM purchases {_NOW}")
ORACLE["trade_edges"] = _cr(f"SELECT * FROM links {_NOW}")
ORACLE["trade_edges_clamped"] = _cr(f"SELECT * FROM trades {_NOW}")
ORACLE["decl_or_ledger"] = _cr(f"SELECT * FROM claimants {_NOW}")
ORACLE["nondeclaring_issuers"] = _cr(f"SELECT * FROM silent {_NOW}")
ORACLE["doc30_issuers"] = _cr(f"SELECT * FROM unlicensed {_NOW}")
ORACLE["alerted_issuers"] = _cr(f"SELECT issuer FROM alerted {_NOW}")
ORACLE["special_credit"] = _cr(f"SELECT id, special_cr, period FROM claimants {_NOW} AND special_cr > 0")
ORACLE["phantom_edges"] = _cr("SELECT * FROM a_edges")
ORACLE["edge_level0"] = _cr("SELECT issuer, receiver, iva_fact, iva_nc, period, 0 AS level, qty_docto, iva_neto, node_kind, "
                            "issuer_declares, receiver_declares FROM a_edges")
ORACLE["hop1_by_origin"] = _cr("SELECT * FROM a_hop1")


def _rounded_cols(cols):
    return ", ".join(f"round(CAST({c} AS DOUBLE), 9) AS {c}" if c in _DBL else c for c in cols)


_RESULT = list(cs.RESULT)
_DBL = set(_RESULT[2:11]) | {"c_537"}
ORACLE["hop1_result"] = _cr(f"SELECT {_rounded_cols(_RESULT)} FROM a_hops WHERE hop = 1")
ORACLE["hop_next"] = _cr(f"SELECT {_rounded_cols(_RESULT)} FROM a_hops WHERE hop > 1")
ORACLE["hops_union"] = _cr(f"SELECT {_rounded_cols(_RESULT)} FROM a_hops")

_SUMMARY = (["period", "receiver", "origin", "f29_fact_reci", "f29_nc_reci", "f29_neto_reci", "c_537", "qty_arco"]
            + [f"{m}_a{k}" for k in range(1, 6) for m in ("iva_neto_cdo", "prop_neto_cdo")]
            + ["total_cont", "prop_total_cont"] + [f"origin_a{k}" for k in range(1, 6)])
_DBL |= {c for c in _SUMMARY if c.startswith(("iva_", "prop_", "total_", "f29_"))}
ORACLE["origin_summary"] = _cr(f"SELECT {_rounded_cols(_SUMMARY)} FROM a_summary")
ORACLE["receivers"] = _cr(f"SELECT {_rounded_cols(['period', 'receiver', 'f29_fact_reci', 'f29_nc_reci', 'f29_neto_reci', 'c_537'])} FROM a_wide")

_MEAS = cs.MEASURES
_PIVOT = ["period", "receiver", "f29_neto_reci"] + [f"{m}_{s}" for s in cs.PIVOT_ORDER for m in _MEAS] + ["c_537"]
_TOTALS = (_PIVOT + [f"{m}_a{k}_an" for k in range(1, 6) for m in ("iva_neto_cdo", "prop_neto_cdo")]
           + ["total_cont_an", "prop_total_cont_an"])
_DBL |= {c for c in _TOTALS if c.startswith(("iva_", "prop_", "total_", "f29_"))}
ORACLE["origin_pivot"] = _cr(f"SELECT {_rounded_cols(_PIVOT)} FROM a_wide")
ORACLE["hop_totals"] = _cr(f"SELECT {_rounded_cols(_TOTALS)} FROM a_totals")
ORACLE["history_upsert"] = _cr(_every(_rounded_cols(_TOTALS), "totals"), ALL)
ORACLE["snapshot_backup"] = _cr(_every(_rounded_cols(_TOTALS), "totals", PERIODS[:-1]), ALL)
ORACLE["table_profile"] = _cr(
    "SELECT period, count(*) AS rows_in_period, sum(count(*)) OVER () AS rows, "
    f"{len(_TOTALS)} AS columns FROM ({_every('period', 'totals')}) h "
    "GROUP BY period", ALL)

_CARRIED = ["period", "receiver", "f29_neto_reci", "period_ant", "f29_77_ant", "prop_total_cont_an_ant",
            "carried_cont", "c_504"]
for _s in cs.CARRIED_ORDER + ("an",):
    for _k in range(1, 6):
        _CARRIED += [f"iva_neto_cdo_a{_k}_{_s}", f"prop_neto_cdo_a{_k}_{_s}"]
    _CARRIED += [f"total_cont_{_s}", f"prop_total_cont_{_s}"]
_DBL |= {"f29_77_ant", "prop_total_cont_an_ant", "carried_cont", "c_504"}
ORACLE["carried_history"] = _cr(_every(_rounded_cols(_CARRIED), "carried"), ALL)
_EXTRACT = (["period", "receiver", "f29_neto_reci", "period_ant", "f29_77_ant", "prop_total_cont_an_ant",
             "carried_cont", "c_504"] + [f"{m}_a{k}_rem" for k in range(1, 6) for m in ("iva_neto_cdo", "prop_neto_cdo")]
            + ["total_cont_rem", "prop_total_cont_rem"])
ORACLE["period_extract"] = _cr(f"SELECT {_rounded_cols(_EXTRACT)} FROM m{PERIODS[-1]}_carried", ALL)
ORACLE["export_csv"] = with_inputs(
    ["observations"], "SELECT id, period, code, CAST(amount AS DOUBLE) AS amount, "
    "strftime(end_date, '%Y-%m-%d %H:%M:%S') AS end_date, status FROM observations")


def final_oracle() -> dict[str, str]:
    """Every twin with its DECIMAL outputs cast to DOUBLE (the Spark queries' report type)."""
    from vatlens.sql.decimal_cols import DECIMAL_COLS
    out = {}
    for k, q in ORACLE.items():
        cols = DECIMAL_COLS.get(k)
        if cols:
            rep = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
            q = f"SELECT * REPLACE ({rep}) FROM ({q}) q"
        out[k] = q
    return out

# ------------------------------------------------------- 2.7 360 and carried
T360 = ("t360", f"""
SELECT c.id, c.is_company, c.is_accountant, c.is_natural, c.is_rep, {r('k.score')} AS contamination,
       CAST(p.paid_total AS DOUBLE) AS paid_total, CAST(v.vat_net AS DOUBLE) AS vat_net, g.region, d.n_documents,
       l.lifetime AS lifetime_days, CASE WHEN s.id IS NULL THEN 0 ELSE 1 END AS initial_alert,
       {r('o.value')} AS opacity, kr.kin_owners, kr.total::DOUBLE AS natural_partners, {r('kr.kinship_rate')} AS kinship_rate,
       c.initial_group, c.community, w.fee_workers, w.dependent_workers, CAST(nw.networth AS DOUBLE) AS networth
FROM communities c
LEFT JOIN con k ON c.id = k.id
LEFT JOIN paid p ON c.id = p.id
LEFT JOIN vnet v ON c.id = v.id
LEFT JOIN lregion g ON c.id = g.id
LEFT JOIN docs d ON c.id = d.id
LEFT JOIN life l ON c.id = l.id
LEFT JOIN (SELECT DISTINCT id FROM seeds) s ON c.id = s.id
LEFT JOIN opres o ON c.id = o.company
LEFT JOIN krate kr ON c.id = kr.company
LEFT JOIN (SELECT COALESCE(f.id, p.id) AS id, COALESCE(f.fee_workers, 0) AS fee_workers,
                  COALESCE(p.dependent_workers, 0) AS dependent_workers
           FROM fl f FULL OUTER JOIN (SELECT id, max(dependent_workers) AS dependent_workers FROM pl GROUP BY id) p
           ON f.id = p.id) w ON c.id = w.id
LEFT JOIN (SELECT company, sum(amount) AS networth FROM networth GROUP BY company) nw ON c.id = nw.company""")

T360_IN = (["communities"] + CON_IN + ["declarations", "invoices", "businesses", "units", "taxpayers"]
           + OPACITY_IN + KIN_IN + ["payroll", "fees", "networth"])
_T360_CTES = (CON_CTES + [PAID, INV, VATNET, REGION, DOCS, LIFE] + OPACITY_CTES + KIN_CTES[1:]
              + [PP, PL, FW, FL, T360])
ORACLE["taxpayer_360"] = with_inputs(T360_IN, "SELECT * FROM t360", _T360_CTES)

LATEST_CARRIED = f"""
SELECT t.*, lc.last_carried_period, {r('lc.carried_cont')} AS carried_cont
FROM t360 t LEFT JOIN (SELECT receiver, max(period) AS last_carried_period, arg_max_null(carried_cont, period) AS carried_cont
  FROM ({_every('period, receiver, carried_cont', 'carried')}) u GROUP BY receiver) lc ON t.id = lc.receiver"""
ORACLE["latest_carried"] = with_inputs(T360_IN + CIN, LATEST_CARRIED, _T360_CTES + ALL)

# --------------------------------------- 2.8 lookups (over the 360 table with carried credit)
COMMUNITY_SIZE = ("csize", "SELECT r.*, s.community_size FROM cratios r LEFT JOIN (SELECT community AS com, count(*) AS community_size "
                  "FROM communities GROUP BY community) s USING (com)")
LOOKUP_IN = T360_IN + CIN + FLOW_IN
_LOOKUP_CTES = _T360_CTES + ALL + [TAGGED, CELLS, TAXPAYER_FLOW, COMMUNITY_FLOW, COMMUNITY_RATIOS, COMMUNITY_SIZE,
                                   ("carried360", LATEST_CARRIED),
                                   ("one", f"SELECT * FROM carried360 WHERE CAST(id AS VARCHAR) = {LOOKUP_KEY}")]
_FLOW_COLS = FLOW_MONEY[:2] + ["arcs_intra_issued", "arcs_extra_issued"] + FLOW_MONEY[2:] + ["arcs_intra_received", "arcs_extra_received"]
_RATIO_NAMES = ["pct_issued_extra", "pct_received_extra", "rate_issued_extra_intra"]
_ONE = ["id", "is_company", "is_accountant", "is_natural", "is_rep", "contamination", "paid_total", "vat_net", "region",
        "n_documents", "lifetime_days", "initial_alert", "opacity", "kin_owners", "natural_partners", "kinship_rate",
        "initial_group", "community", "fee_workers", "dependent_workers", "networth", "last_carried_period", "carried_cont"]
_SHOWN_AS_MONEY = ["paid_total", "vat_net", "networth", "carried_cont"] + FLOW_MONEY + CF_MONEY
_RATIOS = ["contamination", "opacity", "natural_partners", "kinship_rate"] + _RATIO_NAMES


def _real(c: str) -> str:
    return f"round(CAST({c} AS DOUBLE), 9) AS {c}" if c in _SHOWN_AS_MONEY + _RATIOS else c


_COMMUNITY_COLS = _RATIO_NAMES + CF_MONEY + CF_COUNTS + ["community_size"]
ORACLE["lookup_taxpayer"] = with_inputs(
    LOOKUP_IN, "SELECT " + ", ".join(map(_real, _ONE + _FLOW_COLS + _COMMUNITY_COLS))
    + " FROM one LEFT JOIN tflow f ON f.taxpayer = one.id LEFT JOIN csize g ON g.com = one.community", _LOOKUP_CTES)


def _pairs(frame: str, cols: list[str], source: str) -> str:
    """(frame, attribute, value) of each column, as text."""
    def text(c):
        if c in _SHOWN_AS_MONEY:
            return f"{money_text(c)} AS {c}"
        return f"format('{{:,.4f}}', round(CAST({c} AS DOUBLE), 9)) AS {c}" if c in _RATIOS else f"CAST({c} AS VARCHAR) AS {c}"
    return (f"SELECT '{frame}' AS frame, attribute, value FROM (SELECT {', '.join(map(text, cols))} FROM {source}) "
            f"UNPIVOT INCLUDE NULLS (value FOR attribute IN ({', '.join(cols)}))")


ORACLE["lookup_unpivot"] = with_inputs(LOOKUP_IN, " UNION ALL ".join([
    _pairs("taxpayer", _ONE, "one"),
    _pairs("flow", ["taxpayer"] + _FLOW_COLS, "tflow WHERE taxpayer IN (SELECT id FROM one)"),
    _pairs("community", ["com"] + _COMMUNITY_COLS, "csize WHERE com IN (SELECT community FROM one)")]), _LOOKUP_CTES)

ORACLE["extreme_regions"] = with_inputs(["invoice_points", "point_regions"], """
SELECT issuer, total_north, total_south,
       CASE WHEN total_north > 0 AND total_south > 0 THEN 'si' ELSE 'no' END AS sells_extremes
FROM (SELECT issuer, sum(CASE WHEN region IN ('AFRICA') THEN 1 ELSE 0 END) AS total_north,
             sum(CASE WHEN region IN ('EUROPE') THEN 1 ELSE 0 END) AS total_south
      FROM (SELECT issuer, point, count(*) AS c FROM invoice_points WHERE issuer IS NOT NULL GROUP BY issuer, point) pv
      JOIN point_regions pr ON pv.point = pr.point WHERE pr.region IS NOT NULL
      GROUP BY issuer) t""")
