"""DuckDB twin of the credit tracing, derived from the definitions in SURVEY section 2.6.

Relations that need no history hold every period at once (``base``). A period adds what
depends on the period before it (``period_ctes``): the carried credit, the self edges, one
tagged join that gives hop 1, one recursive step over (receiver, origin) for the hops after
it, and conditional aggregates that turn hops and then origins into columns.
"""

from __future__ import annotations

# Origin codes, column orders and code lists that results must share.
ORIGIN_SUFFIX = {1: "nd", 2: "al", 3: "ce", 4: "w08", 5: "rem", 6: "fm01", 7: "ed30"}
PIVOT_ORDER = ("al", "nd", "ce", "w08", "rem", "fm01", "ed30")
TOTAL_ORIGINS = ("al", "rem", "nd", "w08", "fm01", "ed30")
CARRIED_ORDER = ("rem", "nd", "al", "w08", "ed30", "ce", "fm01")
SPECIAL = ("c_725", "c_704", "c_160", "c_126", "c_572", "c_768", "c_767")
INVOICE_CREDIT = ("c_520", "c_762", "c_766", "c_525")
DECLARED = ("id", "period", "fact_amt", "fact_qty", "c_519", "c_520", "fact_cr_sup", "fact_cr_const",
            "fact_cr_fixed", "nc_cr", "fact_cr", "c_538", "nc_qty", "nc_amt", "c_537", "net_cr",
            "special_cr", "c_504")
CREDIT_INPUTS = ["declarations", "observations", "ledger", "authorisations", "alerts"]
HOPS = range(1, 6)
MEASURES = ([f"iva_neto_cdo_a{k}" for k in HOPS] + [f"prop_neto_cdo_a{k}" for k in HOPS]
            + ["total_cont", "prop_total_cont"])
RESULT = ("period", "receiver", "f29_fact_reci", "f29_nc_reci", "f29_neto_reci", "iva_fact_cdo", "iva_nc_cdo",
          "iva_neto_cdo", "prop_fact_cdo", "prop_nc_cdo", "prop_neto_cdo", "hop", "c_537", "origin")

#: Which edges an origin marks: (origin, kind of self edge or NULL for a marked issuer, receiver's kind,
#: receiver must claim credit, label of the row).
ADMITS = """VALUES
  (1, NULL, 'f29', true, 'f29'), (2, NULL, 'f29', true, 'f29'), (7, NULL, 'f29', true, 'f29'),
  (2, NULL, 'rcv', false, 'rcv'), (3, 'PHANTOM CE', 'f29', false, 'f29 CE'), (4, 'PHANTOM CE', 'rcv', false, 'RCV CE'),
  (4, 'PHANTOM W08', 'f29', false, 'f29 W08'), (5, 'PHANTOM REM', 'f29', false, 'f29 REM'),
  (6, 'PHANTOM FM01', 'f29', false, 'f29 FM01')"""
#: How a hop rounds: (hop, credit notes take the invoice proportion, digits of a product, sums to one
#: digit, the issuer's invoice part must be positive).
STEPS = "VALUES (2, true, 1, false, false), (3, false, 1, true, true), (4, false, 5, true, true), (5, false, 5, true, true)"


def prior(p: int) -> int:
    return p - 89 if p % 100 == 1 else p - 1


def total(cols) -> str:
    return " + ".join(f"ifnull({c}, 0)" for c in cols)


def share(a: str, b: str) -> str:
    return f"round({a}::DOUBLE / nullif({b}::DOUBLE, 0), 5)"


def base() -> list[tuple[str, str]]:
    """Relations of all periods."""
    invoice = total(INVOICE_CREDIT)
    zeros = ", ".join(f"0 AS {c}" for c in DECLARED if c not in ("id", "period", "nc_cr", "fact_cr", "c_537", "net_cr"))
    plain = ", ".join(c for c in DECLARED if c != "c_504")
    return [
        # one declaration a taxpayer and period: the valid one with the highest folio
        ("filed", """SELECT * FROM declarations WHERE validity IN (1, 3) AND c_537 > 0
QUALIFY row_number() OVER (PARTITION BY id, period ORDER BY folio DESC) = 1"""),
        ("carryover", f"""SELECT id, period AS period_ant, c_537 AS f29_537_ant, ifnull(c_538, 0) AS f29_538_ant,
  ifnull(c_77, 0) AS f29_77_ant, {total(('c_768', 'c_767'))} AS special_cr_ant,
  round(ifnull(c_77, 0)::DOUBLE / nullif((c_537 + {total(SPECIAL)})::DOUBLE, 0), 6) AS carry_ratio_ant FROM filed"""),
        ("claims", f"""SELECT id, period, c_502 AS fact_amt, c_503 AS fact_qty, c_519, c_520, c_762 AS fact_cr_sup,
  c_766 AS fact_cr_const, c_525 AS fact_cr_fixed, ifnull(c_528, 0) AS nc_cr, {invoice} AS fact_cr, c_538,
  c_509 AS nc_qty, c_510 AS nc_amt, c_537,
  {invoice} + {total(('c_504', 'c_532', 'c_535', 'c_553'))} - ifnull(c_528, 0) AS net_cr,
  {total(SPECIAL)} AS special_cr, ifnull(c_504, 0) AS c_504 FROM filed"""),
        ("notes", "SELECT id, period, amount, code FROM observations WHERE code IN ('FM01', 'W08') AND status = 'V' "
                  "AND end_date IS NULL"),
        # an FM01 note takes from the carried credit; one larger than it takes it all
        ("adjusted", f"""SELECT {', '.join('q.' + c for c in DECLARED if c != 'c_504')}, q.c_504 AS c_504_orig,
  greatest(q.c_504 - ifnull(n.amount, 0), 0) AS c_504, least(q.c_504, ifnull(n.amount, 0)) AS fm01
FROM claims q LEFT JOIN notes n ON n.code = 'FM01' AND n.id = q.id AND n.period = q.period"""),
        ("purchases", """SELECT period, issuer, receiver, if(note, 0, vat) AS iva_fact, if(note, vat, 0) AS iva_nc,
  (NOT note)::INT AS is_fact, note::INT AS is_nc, if(note, -vat, vat) AS signed_vat
FROM (SELECT *, doc_type IN (60, 61) AS note FROM ledger
      WHERE operation = 'COMPRA' AND tx_type BETWEEN 1 AND 6 AND doc_type IN (30, 33, 55, 56, 60, 61)) p"""),
        ("links", """SELECT g.*, EXISTS (FROM adjusted a WHERE a.id = g.issuer AND a.period = g.period)::INT AS issuer_declares,
  EXISTS (FROM adjusted a WHERE a.id = g.receiver AND a.period = g.period)::INT AS receiver_declares
FROM (SELECT issuer, receiver, period, sum(iva_fact) AS iva_fact, sum(iva_nc) AS iva_nc, count(*) AS qty_docto,
        sum(is_fact) AS qty_fact, sum(is_nc) AS qty_nc, ifnull(sum(iva_fact), 0) - ifnull(sum(iva_nc), 0) AS iva_neto1,
        ifnull(sum(signed_vat), 0) AS iva_neto_cv1
      FROM purchases GROUP BY ALL) g"""),
        ("trades", """SELECT * EXCLUDE (iva_neto1, iva_neto_cv1), greatest(iva_neto1, 0) AS iva_neto,
  greatest(iva_neto_cv1, 0) AS iva_neto_cv FROM links"""),
        # who may claim: declarants, and receivers known from the ledger alone
        ("claimants", f"""SELECT DISTINCT {plain.replace('net_cr', 'greatest(net_cr, 0) AS net_cr')}, c_504, 'f29' AS kind FROM adjusted
UNION ALL BY NAME
SELECT receiver AS id, period, {zeros}, sum(iva_nc) AS nc_cr, sum(iva_fact) AS fact_cr, sum(iva_neto) AS c_537,
  greatest(sum(iva_neto), 0) AS net_cr, 'rcv' AS kind
FROM trades WHERE receiver_declares = 0 GROUP BY receiver, period"""),
        ("silent", "SELECT issuer, period, receiver, iva_fact, iva_nc, qty_docto, iva_neto FROM trades WHERE issuer_declares = 0"),
        ("unlicensed", """SELECT DISTINCT issuer, period FROM ledger l WHERE doc_type = 30 AND operation = 'COMPRA'
  AND NOT EXISTS (FROM authorisations a WHERE a.id = l.issuer AND a.attribute = 'POFE' AND a.end_date IS NULL)"""),
        ("alerted", """SELECT DISTINCT issuer, period FROM trades WHERE issuer IN (
  SELECT id FROM alerts WHERE code IN ('4110', '4111', '4112') AND deactivated_by IS NULL AND unblock_folio IS NULL)"""),
        ("marked", """SELECT DISTINCT issuer, period, 1 AS origin FROM silent UNION ALL
SELECT issuer, period, 2 FROM alerted UNION ALL SELECT issuer, period, 7 FROM unlicensed"""),
        ("admits", f"SELECT * FROM ({ADMITS}) v(origin, node_kind, kind, claims_credit, label)"),
        ("steps", f"SELECT * FROM ({STEPS}) v(hop, nc_by_invoice, digits, sums_to_tenth, needs_invoice)"),
    ]


def period_ctes(P: int, x: str, history: str | None = None) -> list[tuple[str, str]]:
    """CTEs ``{x}<name>`` of period ``P`` over those of ``base``; ``history`` names a relation with
    (period, receiver, total_cont_an, prop_total_cont_an) of the periods before."""
    if history is None:
        entering = f"SELECT id AS receiver, 0.0::DOUBLE AS total_cont_an, 0.0::DOUBLE AS prop FROM adjusted WHERE period = {P}"
    else:
        entering = (f"SELECT receiver, total_cont_an::DOUBLE AS total_cont_an, greatest(ifnull(prop_total_cont_an, 0), 0)::DOUBLE AS prop "
                    f"FROM {history} WHERE period = {prior(P)}")
    amount = "(h.prop::DECIMAL(20, 10) * ifnull(a.c_504, 0))" if history else "0"
    carry = f"""SELECT {prior(P)} AS period_ant, h.receiver, {P} AS period, h.total_cont_an AS total_cont_an_ant,
  h.prop AS prop_total_cont_an_ant, c.f29_77_ant, a.c_504_orig, a.c_504, a.fm01, round({amount}, 4)::DOUBLE AS carried_cont
FROM ({entering}) h LEFT JOIN carryover c ON c.id = h.receiver AND c.period_ant = {prior(P)}
LEFT JOIN adjusted a ON a.id = h.receiver AND a.period = {P}"""

    # what a taxpayer brings in itself, as an edge to itself
    edges = f"""SELECT issuer, receiver, period, iva_fact, iva_nc, qty_docto, qty_fact, qty_nc, iva_neto, iva_neto_cv,
  issuer_declares, receiver_declares, 'NORMAL' AS node_kind FROM trades WHERE period = {P}
UNION ALL
SELECT DISTINCT id, id, {P}, 0, 0, 0, 0, 0, amount, 0, 1, 1, 'PHANTOM ' || brought
FROM (SELECT id, sum(special_cr) AS amount, 'CE' AS brought FROM claimants WHERE period = {P} AND special_cr > 0 GROUP BY id
      UNION ALL SELECT id, sum(amount), code FROM notes WHERE period = {P} GROUP BY id, code
      UNION ALL SELECT receiver, carried_cont, 'REM' FROM {x}carry) own"""

    hop1 = f"""SELECT DISTINCT issuer, receiver, period, taken AS iva_fact_cont, returned AS iva_nc_cont, iva_fact, iva_nc, nc_cr,
  iva_neto, qty_docto, fact_cr, net_cr, taken - returned AS neto_ctdo,
  CASE WHEN origin IN (1, 7) AND issuer_declares + receiver_declares = 0 THEN 0
       WHEN iva_neto BETWEEN 0 AND room THEN iva_neto ELSE room END AS iva_neto_cont,
  origin, label AS kind, issuer_declares, receiver_declares
FROM (SELECT e.*, d.nc_cr, d.fact_cr, d.net_cr, w.origin, w.label,
        if(e.iva_fact <= d.fact_cr, e.iva_fact, d.fact_cr) AS taken, if(e.iva_nc <= d.nc_cr, e.iva_nc, d.nc_cr) AS returned,
        d.net_cr + if(w.origin BETWEEN 3 AND 6, d.special_cr, 0) AS room
      FROM {x}edges e JOIN claimants d ON d.id = e.receiver AND d.period = e.period
      JOIN admits w ON w.kind = d.kind AND ifnull(w.node_kind, e.node_kind) = e.node_kind
      LEFT JOIN marked m ON m.issuer = e.issuer AND m.period = e.period AND m.origin = w.origin
      WHERE (w.node_kind IS NOT NULL OR m.origin IS NOT NULL)
        AND (NOT w.claims_credit OR greatest(d.c_520, d.fact_cr_sup, d.fact_cr_const, d.fact_cr_fixed, d.nc_cr) > 0)) hit"""

    # sums within what the receiver claims; special credit is not bounded
    first = f"""SELECT period, receiver, fact_cr AS f29_fact_reci, nc_cr AS f29_nc_reci, whole AS f29_neto_reci,
  f AS iva_fact_cdo, n AS iva_nc_cdo, if(origin = 3, t, least(t, whole)) AS iva_neto_cdo, {share('f', 'fact_cr')} AS prop_fact_cdo,
  {share('n', 'nc_cr')} AS prop_nc_cdo, {share('t', 'whole')} AS prop_neto_cdo, 1 AS hop, c_537, origin
FROM (SELECT s.period, s.receiver, s.origin, d.fact_cr, d.nc_cr, d.c_537, d.net_cr + d.special_cr AS whole,
        least(s.f, d.fact_cr) AS f, least(s.n, d.nc_cr) AS n,
        CASE WHEN s.origin = 3 THEN s.t WHEN s.declarants = 0 THEN 0 ELSE least(s.t, d.net_cr) END AS t
      FROM (SELECT period, receiver, origin, sum(iva_fact_cont) AS f, sum(iva_nc_cont) AS n, sum(iva_neto_cont) AS t,
              sum(issuer_declares + receiver_declares) AS declarants FROM {x}hop1 GROUP BY ALL) s
      JOIN claimants d ON d.id = s.receiver AND d.period = s.period) b"""

    def passed(amount, prop):
        exact = f"e.{amount}::DECIMAL(20, 4) * ({prop})::DECIMAL(10, 5)"
        return f"sum(if(q.digits = 1, round({exact}, 1)::DECIMAL(28, 5), round({exact}, 5)::DECIMAL(28, 5)))"

    def held(v, cap):
        return f"least(if(sums_to_tenth, round({v}, 1)::DOUBLE, {v}::DOUBLE), {cap}::DOUBLE)"

    def part(v, cap):
        return f"if({v}::DOUBLE <= {cap}::DOUBLE, {share(v, cap)}, 1.0)"

    as_double = ", ".join(f"{c}::DOUBLE AS {c}" if c.startswith(("f29", "iva", "prop", "c_")) else c for c in RESULT)
    hops = f"""WITH RECURSIVE reach AS (
SELECT {as_double} FROM {x}first
UNION ALL
SELECT s.period, s.receiver, d.fact_cr::DOUBLE, d.nc_cr::DOUBLE, (d.net_cr + d.special_cr)::DOUBLE,
  {held('f', 'd.fact_cr')}, {held('n', 'd.nc_cr')}, {held('t', 'd.net_cr')},
  {part('f', 'd.fact_cr')}, {part('n', 'd.nc_cr')}, {part('t', 'd.net_cr')}, s.hop, d.c_537::DOUBLE, s.origin
FROM (SELECT e.period, e.receiver, v.origin, q.hop, q.sums_to_tenth, {passed('iva_fact', 'v.prop_fact_cdo')} AS f,
        {passed('iva_nc', 'if(q.nc_by_invoice, v.prop_fact_cdo, v.prop_nc_cdo)')} AS n,
        {passed('iva_neto', 'v.prop_neto_cdo')} AS t
      FROM reach v JOIN steps q ON q.hop = v.hop + 1
      JOIN {x}edges e ON e.issuer = v.receiver AND e.period = v.period AND e.receiver <> e.issuer
      WHERE v.iva_fact_cdo > 0 OR NOT q.needs_invoice GROUP BY ALL) s
JOIN claimants d ON d.id = s.receiver AND d.period = s.period)
SELECT * FROM reach"""

    def at(k, c):
        return f"max({c}) FILTER (WHERE hop = {k})"

    per_hop = ",\n  ".join(f"ifnull({at(k, 'iva_neto_cdo')}, 0) AS v{k}, least(ifnull({at(k, 'prop_neto_cdo')}, 0), 1) AS prop_neto_cdo_a{k}, "
                           f"{at(k, 'origin')} AS origin_a{k}" for k in HOPS)
    summary = f"""SELECT period, receiver, origin, f29_fact_reci, f29_nc_reci, f29_neto_reci, c_537, qty_arco,
  {', '.join(f'iva_neto_cdo_a{k}, prop_neto_cdo_a{k}, origin_a{k}' for k in HOPS)},
  if(origin_a1 = 3, v1, iva_neto_cdo_a1) + {' + '.join(f'iva_neto_cdo_a{k}' for k in HOPS if k > 1)} AS total_cont,
  if(bounded > f29_neto_reci, 1, bounded / nullif(f29_neto_reci, 0)) AS prop_total_cont
FROM (SELECT *, {' + '.join(f'iva_neto_cdo_a{k}' for k in HOPS)} AS bounded
      FROM (SELECT *, {', '.join(f'if(v{k} > 0, least(v{k}, f29_neto_reci), v{k}) AS iva_neto_cdo_a{k}' for k in HOPS)}
            FROM (SELECT period, receiver, origin, max(f29_fact_reci) AS f29_fact_reci, max(f29_nc_reci) AS f29_nc_reci,
  max(f29_neto_reci) AS f29_neto_reci, max(c_537) AS c_537, count(*) AS qty_arco,
  {per_hop}
                  FROM {x}hops WHERE (receiver, period) IN (SELECT (id, period) FROM adjusted) GROUP BY ALL) a) b) c"""

    named = ",\n  ".join(f"max({m}) FILTER (WHERE origin = {code}) AS {m}_{ORIGIN_SUFFIX[code]}" for code in ORIGIN_SUFFIX for m in MEASURES)
    wide = f"""SELECT period, receiver, max(f29_fact_reci) AS f29_fact_reci, max(f29_nc_reci) AS f29_nc_reci,
  max(f29_neto_reci) AS f29_neto_reci, max(c_537) AS c_537,
  {named}
FROM {x}summary GROUP BY period, receiver"""

    over = ", ".join(f"{total(f'{m}_a{k}_{s}' for s in TOTAL_ORIGINS)} AS {m}_a{k}_an" for k in HOPS for m in ("iva_neto_cdo", "prop_neto_cdo"))
    totals = f"""SELECT *, {' + '.join(f'iva_neto_cdo_a{k}_an' for k in HOPS)} AS total_cont_an,
  {' + '.join(f'prop_neto_cdo_a{k}_an' for k in HOPS)} AS prop_total_cont_an FROM (SELECT *, {over} FROM {x}wide) o"""
    carried = f"""SELECT t.*, c.period_ant, c.f29_77_ant, c.prop_total_cont_an_ant, c.carried_cont, a.c_504
FROM {x}totals t LEFT JOIN {x}carry c USING (period, receiver) LEFT JOIN adjusted a ON a.id = t.receiver AND a.period = t.period"""
    return [(x + n, sql) for n, sql in (("carry", carry), ("edges", edges), ("hop1", hop1), ("first", first), ("hops", hops),
                                        ("summary", summary), ("wide", wide), ("totals", totals), ("carried", carried))]
