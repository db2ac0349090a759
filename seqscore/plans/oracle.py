"""Oracle SQL (DuckDB dialect, plain ANSI where possible) for every
registered query.  Each text reads only the base tables; the shared CTEs
below define the same views as ``seqscore.sources.fixtures``.

The SQL is an independent statement of the semantics: windows over the
whole table, brute-force joins and CASE ladders, not a transcript of the
Spark plans.
"""

from __future__ import annotations

from seqscore import constants as C
from seqscore.config import ScoringConfig
from seqscore.sources.fixtures import FIXTURE_RESIDUES

CFG = ScoringConfig()


def r6(expr: str, digits: int = 6) -> str:
    return f"CAST(round_even(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def _case_map(col: str, mapping: dict, default: str = "0.0") -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in mapping.items())
    return f"(CASE {col} {arms} ELSE {default} END)"


_RESIDUE_LIST = "[" + ", ".join(f"'{r}'" for r in FIXTURE_RESIDUES) + "]"

CA_ATOMS = f"""
ca_atoms AS (
  SELECT l_orderkey AS seq_idx, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         ({_RESIDUE_LIST})[CAST(l_partkey % 21 AS INTEGER) + 1] AS resname,
         l_quantity / 10.0 AS x, l_extendedprice / 20000.0 AS y,
         l_discount * 20.0 AS z, 1.0 - l_tax AS plddt
  FROM lineitem)"""

CA_ORDERED = CA_ATOMS + """,
ca_ord AS (
  SELECT *, row_number() OVER (PARTITION BY seq_idx
             ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord
  FROM ca_atoms)"""

_H = _case_map("resname", C.EISENBERG)
_Q = ("(CASE WHEN resname IN ('ARG','LYS') THEN 1 "
      "WHEN resname IN ('ASP','GLU') THEN -1 ELSE 0 END)")

METRICS = CA_ORDERED + f""",
centroid AS (
  SELECT seq_idx, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM ca_atoms GROUP BY seq_idx),
centred AS (
  SELECT a.seq_idx, a.ord, a.resname, a.x, a.y, a.z, a.plddt,
         a.x - c.cx AS dx, a.y - c.cy AS dy, a.z - c.cz AS dz,
         {_H} AS h, {_Q} AS q
  FROM ca_ord a JOIN centroid c ON a.seq_idx = c.seq_idx),
normed AS (
  SELECT *, CASE WHEN sqrt(dx*dx + dy*dy + dz*dz) = 0 THEN 1.0
                 ELSE sqrt(dx*dx + dy*dy + dz*dz) END AS nrm FROM centred),
ends AS (
  SELECT f.seq_idx, sqrt((f.x-l.x)*(f.x-l.x) + (f.y-l.y)*(f.y-l.y) + (f.z-l.z)*(f.z-l.z)) AS dist_nc
  FROM ca_ord f JOIN (SELECT seq_idx, max(ord) AS mx FROM ca_ord GROUP BY seq_idx) m
       ON f.seq_idx = m.seq_idx AND f.ord = 1
  JOIN ca_ord l ON l.seq_idx = m.seq_idx AND l.ord = m.mx),
metrics_raw AS (
  SELECT n.seq_idx, count(*) AS n_res, sum(q) / count(*) AS net_charge,
         sqrt(sum(dx/nrm*h)*sum(dx/nrm*h) + sum(dy/nrm*h)*sum(dy/nrm*h)
              + sum(dz/nrm*h)*sum(dz/nrm*h)) / count(*) AS muH,
         avg(plddt) AS plddt
  FROM normed n GROUP BY n.seq_idx),
scored_raw AS (
  SELECT m.seq_idx, m.n_res, m.net_charge, m.muH, m.plddt, e.dist_nc,
         m.net_charge * {CFG.anionic_fraction} + m.muH * {CFG.hydrophobic_moment_weight}
           + m.plddt - (CASE WHEN e.dist_nc > {CFG.cyclicity_penalty_threshold} THEN 1.0 ELSE 0.0 END)
             * {C.CYCLIC_PENALTY_WEIGHT} AS score,
         e.dist_nc < {CFG.cyclicity_penalty_threshold} AS cyclic_candidate
  FROM metrics_raw m JOIN ends e ON m.seq_idx = e.seq_idx),
scores AS (
  SELECT seq_idx, 'seq_' || CAST(seq_idx AS VARCHAR) AS id, n_res,
         {r6('net_charge')} AS net_charge, {r6('muH')} AS muH, {r6('plddt')} AS plddt,
         {r6('dist_nc')} AS dist_nc, {r6('score')} AS score, cyclic_candidate,
         score AS raw, CAST(score AS DECIMAL(38,12)) AS k
  FROM scored_raw),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY k DESC, seq_idx) AS rank FROM scores),
cut AS (
  SELECT CAST(greatest(1, floor(count(*) * CAST({C.WINNER_FRACTION} AS DOUBLE))) AS BIGINT) AS n_win
  FROM scores),
split AS (
  SELECT r.*, r.rank <= cut.n_win AS is_winner FROM ranked r CROSS JOIN cut)"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


QUERIES: dict[str, str] = {}

QUERIES["structure_metrics"] = with_(METRICS, f"""
SELECT 'seq_' || CAST(seq_idx AS VARCHAR) AS id, n_res, {r6('net_charge')} AS net_charge,
       {r6('muH')} AS muH, {r6('plddt')} AS plddt, {r6('dist_nc')} AS dist_nc
FROM scored_raw""")

QUERIES["composite_score"] = with_(METRICS, """
SELECT id, n_res, net_charge, muH, plddt, dist_nc, score, cyclic_candidate FROM scores""")

QUERIES["top_candidates"] = with_(METRICS, f"""
SELECT id, score, plddt, dist_nc, muH, net_charge FROM scores
ORDER BY k DESC, seq_idx LIMIT {C.DEFAULT_TOP_N}""")

QUERIES["global_rank"] = with_(METRICS, """
SELECT id, score, rank FROM ranked""")

QUERIES["winner_loser_split"] = with_(METRICS, """
SELECT id, score, rank, is_winner FROM split""")

# Brute force: every winner against every loser, nearest by |delta|, ties
# to the loser with the smaller key.
QUERIES["preference_pairs"] = with_(METRICS, f"""
SELECT 'seq_' || CAST(w.seq_idx AS VARCHAR) AS chosen,
       'seq_' || CAST(arg_min(l.seq_idx, (abs(w.k - l.k), l.seq_idx)) AS VARCHAR) AS rejected,
       {r6('w.raw - arg_min(l.raw, (abs(w.k - l.k), l.seq_idx))')} AS margin
FROM split w JOIN split l ON w.is_winner AND NOT l.is_winner
GROUP BY w.seq_idx, w.raw, w.k""")

VALIDATED = METRICS + f""",
energies AS (
  SELECT s.*,
         CASE WHEN o.o_orderstatus <> 'P' THEN o.o_custkey / CAST(4.0 AS DOUBLE) END AS e0,
         CASE WHEN o.o_orderstatus <> 'P' THEN -floor(o.o_totalprice) / CAST(32.0 AS DOUBLE) END AS e1
  FROM scores s LEFT JOIN orders o ON s.seq_idx = o.o_orderkey),
erows AS (
  SELECT seq_idx, id, k, score AS proxy_score, plddt, dist_nc, muH, net_charge,
         {r6('e0', 2)} AS e_initial, {r6('e1', 2)} AS e_final, {r6('e1 - e0', 2)} AS delta_e,
         coalesce(abs(e1 - e0) > {C.CONVERGENCE_DELTA}, false) AS converged
  FROM energies),
nvalid AS (SELECT count(*) AS n FROM erows WHERE e_final IS NOT NULL),
vranks AS (
  SELECT seq_idx,
         row_number() OVER (ORDER BY k DESC, seq_idx) AS rp,
         row_number() OVER (ORDER BY e_final, seq_idx) AS rf
  FROM erows WHERE e_final IS NOT NULL),
allrank AS (SELECT seq_idx, row_number() OVER (ORDER BY k DESC, seq_idx) AS ra FROM erows),
validated AS (
  SELECT e.*,
         CASE WHEN nv.n >= {C.MIN_CORRELATION_ROWS} THEN v.rp ELSE a.ra END AS rank_proxy,
         CASE WHEN nv.n >= {C.MIN_CORRELATION_ROWS} THEN v.rf END AS rank_physics
  FROM erows e LEFT JOIN vranks v ON e.seq_idx = v.seq_idx
  JOIN allrank a ON e.seq_idx = a.seq_idx CROSS JOIN nvalid nv),
corr_in AS (
  SELECT count(*) AS n_total,
         count(*) FILTER (WHERE rank_physics IS NOT NULL) AS n_validated,
         corr(CASE WHEN rank_physics IS NOT NULL THEN CAST(rank_proxy AS DOUBLE) END,
              CASE WHEN rank_physics IS NOT NULL THEN CAST(rank_physics AS DOUBLE) END) AS rho,
         arg_max(id, (k, -seq_idx)) AS best_proxy,
         arg_min(id, (e_final, seq_idx)) FILTER (WHERE e_final IS NOT NULL) AS best_physics,
         avg(delta_e) FILTER (WHERE e_final IS NOT NULL) AS mean_de
  FROM validated),
t_in AS (
  SELECT *, n_validated - 2 AS nu,
         abs(rho) * sqrt((n_validated - 2) / (1.0 - rho * rho)) AS t
  FROM corr_in),
theta_in AS (SELECT *, atan(t / sqrt(nu)) AS th FROM t_in),
pv AS (
  SELECT *,
    CASE WHEN n_validated < 3 THEN NULL
         WHEN abs(rho) >= 1.0 THEN 0.0
         WHEN nu % 2 = 0 THEN
           1.0 - sin(th) * list_sum([exp(lgamma(k + 0.5) - lgamma(k + 1) - lgamma(0.5))
                                     * pow(cos(th) * cos(th), k) FOR k IN range(0, nu // 2)])
         ELSE
           1.0 - 2.0 / pi() * (th + sin(th) * coalesce(list_sum(
             [cos(th) * pow(cos(th) * cos(th), k - 1)
              * exp((2 * k - 1) * ln(2.0) + lgamma(k) + lgamma(k + 1) - lgamma(2 * k + 1))
              FOR k IN range(1, (nu - 1) // 2 + 1)]), 0.0))
    END AS p_raw
  FROM theta_in),
corr_out AS (
  SELECT n_validated, n_total,
         {r6('CASE WHEN n_validated >= 3 THEN coalesce(rho, 0.0) ELSE 0.0 END', 4)} AS spearman_rho,
         {r6('CASE WHEN n_validated >= 3 THEN greatest(0.0, least(1.0, p_raw)) ELSE 1.0 END', 4)} AS spearman_pval,
         CASE WHEN n_validated < {C.MIN_CORRELATION_ROWS} THEN '{C.INSUFFICIENT_LABEL}'
              WHEN coalesce(rho, 0.0) > {C.AGREEMENT_LABELS[0][0]} THEN '{C.AGREEMENT_LABELS[0][1]}'
              WHEN coalesce(rho, 0.0) > {C.AGREEMENT_LABELS[1][0]} THEN '{C.AGREEMENT_LABELS[1][1]}'
              WHEN coalesce(rho, 0.0) > {C.AGREEMENT_LABELS[2][0]} THEN '{C.AGREEMENT_LABELS[2][1]}'
              ELSE '{C.NO_AGREEMENT_LABEL}' END AS interpretation,
         best_proxy, best_physics, {r6('mean_de', 2)} AS mean_delta_e
  FROM pv)"""

QUERIES["energy_validation"] = with_(VALIDATED, """
SELECT id, proxy_score, plddt, dist_nc, muH, net_charge, e_initial, e_final, delta_e, converged,
       rank_proxy, rank_physics FROM validated""")

QUERIES["rank_correlation"] = with_(VALIDATED, """
SELECT n_validated, n_total, spearman_rho, spearman_pval, interpretation FROM corr_out""")

QUERIES["validation_summary"] = with_(VALIDATED, f"""
SELECT n_validated, n_total, spearman_rho, spearman_pval, interpretation,
       '{C.FORCEFIELD_LABEL}' AS forcefield, best_proxy, best_physics, mean_delta_e FROM corr_out""")

QUERIES["rmsd"] = with_(CA_ORDERED + """,
relaxed AS (SELECT seq_idx, ord, x + (ord % 3) * 0.125 AS x, y - 0.25 AS y, z FROM ca_ord)""", f"""
SELECT 'seq_' || CAST(a.seq_idx AS VARCHAR) AS id,
       {r6('sqrt(avg((r.x - a.x) * (r.x - a.x) + (r.y - a.y) * (r.y - a.y) + (r.z - a.z) * (r.z - a.z)))', 3)} AS rmsd,
       count(*) AS n_atoms
FROM ca_ord a JOIN relaxed r ON a.seq_idx = r.seq_idx AND a.ord = r.ord
GROUP BY a.seq_idx""")


def fixed(expr: str, digits: int) -> str:
    """The value as written to a fixed-width text column, read back."""
    return f"CAST(round_even(CAST({expr} AS DECIMAL(20,7)), {digits}) AS DOUBLE)"


# Every structure's atoms before and after as lists of names: what both hold,
# what one lacks.
QUERIES["rmsd_all_atoms"] = with_(CA_ORDERED + f""",
before AS (
  SELECT seq_idx, ord, x, y, z, (CASE WHEN ord % 2 = 1 THEN 'A' ELSE 'B' END) || ((ord - 1) // 2 // 5 + 1) || '/' ||
         ['N', 'CA', 'C', 'O', 'CB'][CAST((ord - 1) // 2 % 5 AS INTEGER) + 1] AS name
  FROM ca_ord),
relaxed AS (
  SELECT seq_idx, name, x + (ord % 3) * 0.125 AS x, y - 0.25 AS y, z
  FROM before WHERE NOT (seq_idx % 7 = 3 AND ord = 1)
  UNION ALL
  SELECT seq_idx, 'A1/OXT', x, y - 0.25, z FROM before WHERE seq_idx % 11 = 5 AND ord = 1),
b AS (SELECT seq_idx, name, {fixed('x', 3)} AS x, {fixed('y', 3)} AS y, {fixed('z', 3)} AS z FROM before),
r AS (SELECT seq_idx, name, {fixed('x', 3)} AS x, {fixed('y', 3)} AS y, {fixed('z', 3)} AS z FROM relaxed),
sides AS (
  SELECT seq_idx, (SELECT count(*) FROM b WHERE b.seq_idx = s.seq_idx) AS nb,
         (SELECT count(*) FROM r WHERE r.seq_idx = s.seq_idx) AS nr
  FROM (SELECT DISTINCT seq_idx FROM b) s),
paired AS (
  SELECT b.seq_idx, count(*) AS n,
         {r6('sqrt(avg((r.x - b.x) * (r.x - b.x) + (r.y - b.y) * (r.y - b.y) + (r.z - b.z) * (r.z - b.z)))', 3)} AS rmsd
  FROM b JOIN r ON b.seq_idx = r.seq_idx AND b.name = r.name GROUP BY b.seq_idx),
counted AS (
  SELECT s.*, coalesce(n, 0) AS n, rmsd, nb - coalesce(n, 0) AS miss, nr - coalesce(n, 0) AS added
  FROM sides s LEFT JOIN paired p ON p.seq_idx = s.seq_idx)""", """
SELECT 'seq_' || CAST(seq_idx AS VARCHAR) AS id, CASE WHEN miss + added = 0 THEN n END AS n_atoms,
       CASE WHEN miss + added = 0 THEN rmsd END AS rmsd, miss AS n_missing, added AS n_added,
       CASE WHEN nr = 0 THEN 'no atoms after'
            WHEN miss + added > 0 THEN 'atoms differ: ' || miss || ' missing, ' || added || ' added' END AS error
FROM counted""")


# -- sequences -----------------------------------------------------------------

def d(v: float) -> str:
    """A DOUBLE literal (mirrors Spark's double arithmetic exactly)."""
    return f"CAST({v!r} AS DOUBLE)"


PEPTIDES = f"""
peptides AS (
  SELECT doc_id AS seq_idx, 'seq_' || CAST(doc_id AS VARCHAR) AS id,
         regexp_replace(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')),
                        '[^{C.AMINO_ACIDS}]', '', 'g') AS sequence
  FROM documents)"""


def cnt(s: str, ch: str) -> str:
    return f"(length({s}) - length(replace({s}, '{ch}', '')))"


def hydro_sql(s: str) -> str:
    total = " + ".join(f"{cnt(s, aa)} * {d(v)}" for aa, v in C.KYTE_DOOLITTLE.items())
    return f"(CASE WHEN length({s}) > 0 THEN ({total}) / length({s}) END)"


def charge_sql(s: str, ph: str, pka: dict) -> str:
    pos = lambda k: f"({d(1.0)} / ({d(1.0)} + pow({d(10.0)}, {ph} - {d(k)})))"
    neg = lambda k: f"({d(1.0)} / ({d(1.0)} + pow({d(10.0)}, {d(k)} - {ph})))"
    z = f"{pos(pka['Nterm'])} - {neg(pka['Cterm'])}"
    for aa in C.POSITIVE_SIDE_CHAINS:
        z = f"({z}) + {cnt(s, aa)} * {pos(pka[aa])}"
    for aa in C.NEGATIVE_SIDE_CHAINS:
        z = f"({z}) - {cnt(s, aa)} * {neg(pka[aa])}"
    return z


QUERIES["normalize_ids"] = with_(PEPTIDES + r""",
raw AS (SELECT id, sequence, ' ' || chr(9) || lower(sequence) || chr(10) AS raw FROM peptides),
norm AS (SELECT id, sequence, upper(regexp_replace(raw, '^\s+|\s+$', '', 'g')) AS normalized FROM raw)""",
f"""
SELECT id, TRY_CAST(NULLIF(regexp_extract(id, '^seq_(\\d+)$', 1), '') AS BIGINT) AS parsed_idx,
       normalized, normalized = sequence AS roundtrip_ok,
       {cnt('normalized', 'C')} AS cys_count,
       CASE WHEN starts_with(replace(normalized, chr(10), ''), 'M')
                 AND length(replace(normalized, chr(10), '')) > 1
            THEN substr(replace(normalized, chr(10), ''), 2)
            ELSE replace(normalized, chr(10), '') END AS cleaned,
       substr(normalized, 1, 25) AS preview
FROM norm""")

QUERIES["hydrophobicity"] = with_(PEPTIDES, f"""
SELECT id, {r6(hydro_sql('sequence'))} AS hydrophobicity FROM peptides""")

QUERIES["charge"] = with_(PEPTIDES, f"""
SELECT id, {r6(f"CASE WHEN length(sequence) > 0 THEN {charge_sql('sequence', d(7.4), C.PKA_LEHNINGER)} END")}
       AS charge FROM peptides""")

PI_STEPS = 40
PI_ITER = PEPTIDES + f""",
bisect AS (
  SELECT seq_idx, sequence, 0 AS step, {d(0.0)} AS lo, {d(14.0)} AS hi FROM peptides
  UNION ALL
  SELECT seq_idx, sequence, step + 1,
         CASE WHEN ({charge_sql('sequence', f'((lo + hi) / {d(2.0)})', C.PKA_EMBOSS)}) > 0
              THEN (lo + hi) / {d(2.0)} ELSE lo END,
         CASE WHEN ({charge_sql('sequence', f'((lo + hi) / {d(2.0)})', C.PKA_EMBOSS)}) > 0
              THEN hi ELSE (lo + hi) / {d(2.0)} END
  FROM bisect WHERE step < {PI_STEPS}),
pi AS (
  SELECT seq_idx, CASE WHEN length(sequence) > 0 THEN (lo + hi) / {d(2.0)} END AS pi
  FROM bisect WHERE step = {PI_STEPS})"""

QUERIES["isoelectric_point"] = "WITH RECURSIVE " + PI_ITER.strip() + f"""
SELECT 'seq_' || CAST(seq_idx AS VARCHAR) AS id, {r6('pi', 4)} AS isoelectric_point FROM pi"""

INSTABILITY = PEPTIDES + f""",
dps AS (
  SELECT seq_idx, substr(sequence, i, 2) AS dipeptide
  FROM (SELECT seq_idx, sequence, unnest(range(1, length(sequence))) AS i
        FROM peptides WHERE length(sequence) >= 2)),
weights AS (
  SELECT substr('{C.AMINO_ACIDS}', i + 1, 1) || substr('{C.AMINO_ACIDS}', j + 1, 1) AS dipeptide,
         ((7 * i + 13 * j) % 29 - 14) / {d(2.0)} AS weight
  FROM range(0, 20) a(i) CROSS JOIN range(0, 20) b(j)),
ii AS (
  SELECT p.seq_idx,
         CASE WHEN length(p.sequence) > 0 THEN
           {d(10.0)} * coalesce((SELECT sum(coalesce(w.weight, 0.0)) FROM dps x
                                LEFT JOIN weights w ON x.dipeptide = w.dipeptide
                                WHERE x.seq_idx = p.seq_idx), 0.0) / length(p.sequence) END
           AS instability_index
  FROM peptides p)"""

QUERIES["instability"] = with_(INSTABILITY, f"""
SELECT 'seq_' || CAST(seq_idx AS VARCHAR) AS id, {r6('instability_index')} AS instability_index FROM ii""")

QUERIES["descriptors"] = "WITH RECURSIVE " + (INSTABILITY + "," + PI_ITER.replace(PEPTIDES + ",", "", 1)).strip() + f"""
SELECT p.id, doc.lang, doc.source, length(p.sequence) AS length,
       {r6(hydro_sql('p.sequence'))} AS hydrophobicity,
       {r6(f"CASE WHEN length(p.sequence) > 0 THEN {charge_sql('p.sequence', d(7.4), C.PKA_LEHNINGER)} END")} AS charge,
       {r6('ii.instability_index')} AS instability_index,
       {r6('pi.pi', 4)} AS isoelectric_point
FROM peptides p JOIN documents doc ON p.seq_idx = doc.doc_id
LEFT JOIN ii ON p.seq_idx = ii.seq_idx LEFT JOIN pi ON p.seq_idx = pi.seq_idx"""

QUERIES["descriptors_first"] = QUERIES["descriptors"] + """
WHERE p.seq_idx < 100"""

QUERIES["csv_ids"] = with_(PEPTIDES, """
SELECT 'seq_' || CAST(row_number() OVER (ORDER BY p.seq_idx) - 1 AS VARCHAR) AS id, p.seq_idx AS doc,
       doc.lang, doc.source, length(p.sequence) AS length
FROM peptides p JOIN documents doc ON doc.doc_id = p.seq_idx""")

QUERIES["attach_sequence"] = with_(METRICS + "," + PEPTIDES, f"""
SELECT r.id, coalesce(p.sequence, '') AS sequence, r.net_charge, r.muH, r.plddt, r.dist_nc, r.score,
       r.cyclic_candidate, {cnt("coalesce(p.sequence, '')", 'C')} AS cys_count, r.rank
FROM ranked r LEFT JOIN peptides p ON r.seq_idx = p.seq_idx""")

QUERIES["training_triplets"] = with_(METRICS + "," + PEPTIDES + """,
top_loser AS (SELECT seq_idx, score FROM split WHERE rank = (SELECT n_win + 1 FROM cut))""", f"""
SELECT '{C.TRAINING_PROMPT}' AS prompt, w.id AS chosen_id, 'seq_' || CAST(l.seq_idx AS VARCHAR) AS rejected_id,
       pc.sequence AS chosen, pr.sequence AS rejected
FROM split w CROSS JOIN top_loser l
LEFT JOIN peptides pc ON pc.seq_idx = w.seq_idx
LEFT JOIN peptides pr ON pr.seq_idx = l.seq_idx
WHERE w.is_winner""")


# -- joins ---------------------------------------------------------------------

QUERIES["nearest_join"] = """
WITH p AS (SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'),
     v AS (SELECT event_id, user_id, value FROM events WHERE event_type = 'view')
SELECT p.user_id, p.event_id AS purchase_id, p.value AS purchase_value,
       arg_min(v.event_id, (abs(p.value - v.value), v.value, v.event_id)) AS view_id,
       arg_min(v.value, (abs(p.value - v.value), v.value, v.event_id)) AS view_value
FROM p LEFT JOIN v ON p.user_id = v.user_id
GROUP BY p.user_id, p.event_id, p.value"""

FINISHED = """,
finished AS (SELECT o_orderkey AS seq_idx FROM orders WHERE o_orderstatus = 'F')"""

QUERIES["existing_semi"] = with_(METRICS + FINISHED, """
SELECT id, score FROM scores WHERE seq_idx IN (SELECT seq_idx FROM finished)""")

QUERIES["pending_anti"] = with_(METRICS + FINISHED, """
SELECT id, score FROM scores s WHERE NOT EXISTS (SELECT 1 FROM finished f WHERE f.seq_idx = s.seq_idx)""")

_SCALE_VALUES = ", ".join(f"('{k}', {d(v)})" for k, v in sorted(C.EISENBERG.items()))

QUERIES["scale_join"] = with_(CA_ATOMS + f""",
scale(resname, h) AS (VALUES {_SCALE_VALUES})""", f"""
SELECT 'seq_' || CAST(a.seq_idx AS VARCHAR) AS id, count(*) AS n_res,
       count(*) FILTER (WHERE s.h IS NULL) AS n_unknown, {r6('sum(coalesce(s.h, 0.0))')} AS h_sum
FROM ca_atoms a LEFT JOIN scale s ON a.resname = s.resname
GROUP BY a.seq_idx HAVING count(*) FILTER (WHERE s.h IS NULL) > 0""")


# -- reports ---------------------------------------------------------------------

QUERIES["row_counts"] = with_(METRICS, """
SELECT CAST(sum(n_res) AS BIGINT) AS n_atoms, count(*) AS n_structures,
       min(score) AS min_score, max(score) AS max_score FROM scores""")

ATTACHED = METRICS + "," + PEPTIDES + f""",
attached AS (
  SELECT r.*, coalesce(p.sequence, '') AS sequence, {cnt("coalesce(p.sequence, '')", 'C')} AS cys_count
  FROM ranked r LEFT JOIN peptides p ON r.seq_idx = p.seq_idx)"""

QUERIES["batch_summary"] = with_(ATTACHED, f"""
SELECT count(*) AS n_scored, count(*) FILTER (WHERE cyclic_candidate) AS n_cyclic,
       count(*) FILTER (WHERE cys_count >= 2) AS n_multi_cys,
       {r6('avg(plddt)')} AS mean_plddt, {r6('avg(score)')} AS mean_score,
       min(score) AS min_score, max(score) AS max_score FROM attached""")

PAIRS = METRICS + f""",
top_loser AS (SELECT seq_idx, raw FROM split WHERE rank = (SELECT n_win + 1 FROM cut)),
pairs AS (
  SELECT w.id AS chosen, 'seq_' || CAST(l.seq_idx AS VARCHAR) AS rejected, {r6('w.raw - l.raw')} AS margin
  FROM split w CROSS JOIN top_loser l WHERE w.is_winner)"""

QUERIES["margin_stats"] = with_(PAIRS, f"""
SELECT count(*) AS n_pairs, min(margin) AS min_margin, max(margin) AS max_margin,
       {r6('avg(margin)')} AS mean_margin FROM pairs""")

QUERIES["reject_diversity"] = with_(PAIRS + """,
per_reject AS (SELECT rejected, count(*) AS n FROM pairs GROUP BY rejected),
top AS (SELECT arg_max(rejected, (n, rejected)) AS top_reject, max(n) AS top_n FROM per_reject)""", f"""
SELECT count(*) AS n_pairs, count(DISTINCT chosen) AS n_distinct_chosen,
       count(DISTINCT rejected) AS n_distinct_rejected, (SELECT top_reject FROM top) AS top_reject,
       {r6('(SELECT top_n FROM top) / count(*)')} AS top_reject_share
FROM pairs""")

COHORTS = METRICS + FINISHED + """,
cohorts AS (
  SELECT s.*, CASE WHEN f.seq_idx IS NOT NULL THEN 'original' ELSE 'generated' END AS cohort
  FROM scores s LEFT JOIN finished f ON s.seq_idx = f.seq_idx)"""

QUERIES["above_p90"] = with_(COHORTS + """,
thr AS (SELECT quantile_cont(score, 0.9) AS p FROM cohorts WHERE cohort = 'original')""", f"""
SELECT count(*) AS n_other, count(*) FILTER (WHERE score > (SELECT p FROM thr)) AS n_above,
       {r6('(SELECT p FROM thr)')} AS threshold
FROM cohorts WHERE cohort = 'generated'""")

QUERIES["score_hist"] = with_(COHORTS + """,
rng AS (SELECT min(score) AS lo, max(score) AS hi FROM cohorts)""", """
SELECT cohort,
       CAST(CASE WHEN rng.hi > rng.lo
                 THEN least(20, floor((score - rng.lo) / (rng.hi - rng.lo) * CAST(20.0 AS DOUBLE)) + 1)
                 ELSE 1 END AS BIGINT) AS bucket,
       count(*) AS n
FROM cohorts CROSS JOIN rng GROUP BY 1, 2""")

QUERIES["dist_hist"] = QUERIES["score_hist"].replace("min(score) AS lo, max(score) AS hi",
                                                     "min(dist_nc) AS lo, max(dist_nc) AS hi").replace(
    "(score - rng.lo)", "(dist_nc - rng.lo)")

QUERIES["chart_sets"] = with_(VALIDATED + "," + PEPTIDES, f"""
SELECT v.id, v.plddt, v.proxy_score AS score, v.e_final IS NOT NULL AS validated, v.muH, v.net_charge,
       v.rank_proxy, v.rank_physics, coalesce({cnt('p.sequence', 'C')}, 0) >= 2 AS cys_badge
FROM validated v LEFT JOIN peptides p ON v.seq_idx = p.seq_idx""")

QUERIES["ranked_report"] = with_(ATTACHED, f"""
SELECT rank, sequence, score, plddt, dist_nc, cyclic_candidate, cys_count
FROM attached WHERE rank <= {C.DEFAULT_TOP_N}""")

QUERIES["validation_report"] = with_(VALIDATED + "," + PEPTIDES + f""",
relaxed AS (SELECT seq_idx, ord, x + (ord % 3) * 0.125 AS x, y - 0.25 AS y, z FROM ca_ord),
moved AS (
  SELECT a.seq_idx,
         {r6('sqrt(avg((r.x - a.x) * (r.x - a.x) + (r.y - a.y) * (r.y - a.y) + (r.z - a.z) * (r.z - a.z)))', 3)} AS rmsd
  FROM ca_ord a JOIN relaxed r ON a.seq_idx = r.seq_idx AND a.ord = r.ord GROUP BY a.seq_idx)""", """
SELECT v.id, rank_physics, rank_proxy, coalesce(p.sequence, '') AS sequence, e_final, delta_e, rmsd, plddt
FROM validated v LEFT JOIN peptides p ON p.seq_idx = v.seq_idx LEFT JOIN moved m ON m.seq_idx = v.seq_idx
WHERE e_final IS NOT NULL""")

QUERIES["candidate_table"] = with_(ATTACHED, """
SELECT rank, id, sequence, score, plddt, dist_nc, muH, net_charge, cyclic_candidate, cys_count,
       cys_count >= 2 AS cys_badge FROM attached""")

QUERIES["stratified_pairs"] = with_(METRICS + """,
nn AS (SELECT n_win, (SELECT count(*) FROM scores) - n_win AS n_lose FROM cut),
binned AS (
  SELECT s.*, CAST(floor(CAST((s.rank - nn.n_win - 1) * nn.n_win AS DOUBLE) / nn.n_lose) + 1 AS BIGINT) AS bin,
         ((s.seq_idx + 7) % 2147483647) * 48271 % 2147483647 AS h
  FROM split s CROSS JOIN nn WHERE NOT s.is_winner),
picks AS (SELECT bin, arg_min(id, (h, seq_idx)) AS rid, arg_min(raw, (h, seq_idx)) AS rscore
          FROM binned GROUP BY bin)""", f"""
SELECT w.id AS chosen, p.rid AS rejected, {r6('w.raw - p.rscore')} AS margin, w.rank AS stratum
FROM split w JOIN picks p ON p.bin = w.rank WHERE w.is_winner""")


# -- sources and sinks ---------------------------------------------------------

QUERIES["csv_roundtrip"] = QUERIES["composite_score"]
QUERIES["jsonl_roundtrip"] = QUERIES["preference_pairs"]
QUERIES["summary_roundtrip"] = QUERIES["validation_summary"]
QUERIES["fasta_roundtrip"] = with_(PEPTIDES, """
SELECT id, sequence FROM peptides WHERE length(sequence) > 0""")


PDB_METRICS = f"""
ca_atoms AS (
  SELECT l_orderkey AS seq_idx, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         ({_RESIDUE_LIST})[CAST(l_partkey % 21 AS INTEGER) + 1] AS resname,
         {fixed('l_quantity / 10.0', 3)} AS x, {fixed('l_extendedprice / 20000.0', 3)} AS y,
         {fixed('l_discount * 20.0', 3)} AS z, {fixed('1.0 - l_tax', 2)} AS plddt
  FROM lineitem)""" + METRICS[len(CA_ATOMS):]

QUERIES["pdb_roundtrip"] = with_(PDB_METRICS, """
SELECT id, n_res, net_charge, muH, plddt, dist_nc, score FROM scores""")
QUERIES["stream_score"] = QUERIES["pdb_roundtrip"]
QUERIES["resumed_score"] = QUERIES["pdb_roundtrip"]
QUERIES["file_inventory"] = """
SELECT DISTINCT 'seq_' || CAST(l_orderkey AS VARCHAR) AS id FROM lineitem"""

QUERIES["guarded_map"] = with_(METRICS, f"""
SELECT s.id,
       CASE WHEN o.o_orderstatus = 'P' OR o.o_orderkey IS NULL OR o.o_custkey = 0 THEN NULL
            ELSE {r6('((-floor(o.o_totalprice) / CAST(32.0 AS DOUBLE)) - o.o_custkey / CAST(4.0 AS DOUBLE)) / abs(o.o_custkey / CAST(4.0 AS DOUBLE))')}
       END AS ratio,
       CASE WHEN o.o_orderstatus = 'P' OR o.o_orderkey IS NULL THEN 'ValueError: energy missing'
            WHEN o.o_custkey = 0 THEN 'ZeroDivisionError: float division by zero'
            ELSE NULL END AS error
FROM scores s LEFT JOIN orders o ON s.seq_idx = o.o_orderkey""")

_ONE_LETTER = {a: C.EISENBERG[n] for n, a in zip(C.THREE_LETTER, C.AMINO_ACIDS, strict=True)}

QUERIES["guarded_moment"] = with_(PEPTIDES + f""",
residues AS (
  SELECT seq_idx, i - 1 AS i, {_case_map('substr(sequence, i, 1)', _ONE_LETTER)} AS h
  FROM (SELECT seq_idx, sequence, unnest(range(1, length(sequence) + 1)) AS i FROM peptides)),
wound AS (
  SELECT seq_idx, count(*) AS n, sum(h * cos(radians(100.0 * i))) AS c, sum(h * sin(radians(100.0 * i))) AS s
  FROM residues GROUP BY seq_idx)""", f"""
SELECT p.id, CASE WHEN length(p.sequence) >= 2 THEN {r6('sqrt(c * c + s * s) / n')} END AS moment,
       CASE WHEN coalesce(length(p.sequence), 0) < 2 THEN 'ValueError: sequence too short' END AS error
FROM peptides p LEFT JOIN wound w ON w.seq_idx = p.seq_idx""")

QUERIES["legacy_positions"] = with_(METRICS, """
SELECT id, 'seq_' || CAST(row_number() OVER (ORDER BY encode(id || '.pdb')) - 1 AS VARCHAR) AS legacy_id, net_charge
FROM scores""")
