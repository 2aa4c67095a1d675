"""DuckDB oracle SQL for the registered queries.

Each statement recomputes its answer from the raw tables (shingles, SHA-1
hashes, permutations as literal VALUES, 128-bit arithmetic for the 2**64
wrap, md5-derived hyperplanes), independent of the Spark code paths.
"""

from __future__ import annotations

from simpairs.operators import probing
from simpairs.operators.minhash import permutations
from simpairs.plans import queries as Q

M32 = 4294967295
P61 = 2305843009213693951
TWO52 = "4503599627370496.0"
TWO_PI = "6.283185307179586"
WS = r"[ \t\n\r\f\x0B]+"


def _perms() -> str:
    ab = permutations(Q.SEED, 128)
    rows = ",".join(f"({i},{int(a)},{int(b)})" for i, (a, b) in enumerate(ab))
    return f"perms(perm, a, b) AS (SELECT col0::INTEGER, col1::BIGINT, col2::BIGINT FROM (VALUES {rows}))"


# ---------------------------------------------------------------- set sources

def _doc_sets(name="doc_sets", where="TRUE") -> str:
    k = Q.SHINGLE
    return f"""{name}_tok AS (
  SELECT doc_id AS key,
         list_filter(regexp_split_to_array(lower(text), '{WS}'), lambda x: x <> '') AS t
  FROM documents WHERE {where}),
{name} AS (
  SELECT DISTINCT key, array_to_string(t[i:i + {k - 1}], ' ') AS element
  FROM (SELECT key, t, unnest(range(1, greatest(len(t) - {k - 1}, 1) + 1)) AS i
        FROM {name}_tok WHERE len(t) > 0))"""


def _ev_triples() -> str:
    return """ev_tr AS (
  SELECT user_id AS "user", json_extract_string(props, '$.k')::BIGINT AS item,
         value AS rating, event_id FROM events)"""


def _ev_ratings() -> str:
    return _ev_triples() + """,
ev_r AS (SELECT "user", item, max(rating) AS rating FROM ev_tr GROUP BY "user", item)"""


def _ev_sets() -> str:
    return _ev_triples() + """,
ev_sets AS (SELECT DISTINCT "user" AS key, item::VARCHAR AS element FROM ev_tr)"""


def _baskets() -> str:
    return """bk AS (
  SELECT o_custkey AS "user", l_partkey AS item, max(l_quantity) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey),
bk_sets AS (SELECT "user" AS key, item::VARCHAR AS element FROM bk)"""


# ---------------------------------------------------------------- sketches

def _hv(expr: str) -> str:
    return (f"('0x' || substr(sha1({expr}), 7, 2) || substr(sha1({expr}), 5, 2) || "
            f"substr(sha1({expr}), 3, 2) || substr(sha1({expr}), 1, 2))::BIGINT")


def _sig(src: str, name: str) -> str:
    return f"""{name}_h AS (SELECT key, {_hv('element')} AS hv FROM {src}),
{name} AS (
  SELECT key, perm,
         min((((a::HUGEINT * hv + b) % (1::HUGEINT << 64)) % {P61})::BIGINT & {M32}) AS v
  FROM {name}_h CROSS JOIN perms GROUP BY key, perm)"""


def _bands(sig: str, name: str) -> str:
    b, r = Q.BANDS, Q.ROWS
    return f"""{name} AS (
  SELECT key, (perm // {r})::INTEGER AS band,
         string_agg(lpad(hex(v), 8, '0'), '' ORDER BY perm) AS bucket
  FROM {sig} WHERE perm < {b * r} GROUP BY key, perm // {r})"""


def _cand(idx: str, name: str, reps: str | None = None) -> str:
    """Candidate pairs; with ``reps`` (key, rep) only pairs of representatives."""
    only = f"WHERE a.key IN (SELECT rep FROM {reps}) AND b.key IN (SELECT rep FROM {reps})" if reps else ""
    return f"""{name} AS (
  SELECT DISTINCT a.key AS u, b.key AS v FROM {idx} a JOIN {idx} b
    ON a.band = b.band AND a.bucket = b.bucket AND a.key < b.key {only})"""


DOC_REPS = r"""doc_reps AS (
  SELECT doc_id AS key, min(doc_id) OVER (PARTITION BY text) AS rep FROM documents
  WHERE regexp_matches(text, '[^ \t\n\r\f\x0B]'))"""

EV_REPS = """ev_reps AS (
  SELECT key, min(key) OVER (PARTITION BY members) AS rep
  FROM (SELECT key, string_agg(element, ',' ORDER BY element) AS members FROM ev_sets GROUP BY key))"""


def _doc_index(name="doc_idx", where="TRUE") -> str:
    return ",\n".join([_doc_sets(f"{name}_s", where), _sig(f"{name}_s", f"{name}_sig"),
                       _bands(f"{name}_sig", name)])


def _ev_index() -> str:
    return ",\n".join([_ev_sets(), _sig("ev_sets", "ev_sig"), _bands("ev_sig", "ev_idx")])


def _bk_index() -> str:
    return ",\n".join([_baskets(), _sig("bk_sets", "bk_sig"), _bands("bk_sig", "bk_idx")])


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _jaccard_verified(sets: str, cand: str, threshold: float) -> str:
    return f"""sz AS (SELECT key, count(*) AS n FROM {sets} GROUP BY key),
ov AS (SELECT c.u, c.v, count(*) AS o FROM {cand} c
         JOIN {sets} x ON x.key = c.u JOIN {sets} y ON y.key = c.v AND y.element = x.element
       GROUP BY c.u, c.v),
sc AS (SELECT c.u, c.v, coalesce(ov.o, 0)::DOUBLE / (su.n + sv.n - coalesce(ov.o, 0)) AS jaccard
       FROM {cand} c JOIN sz su ON su.key = c.u JOIN sz sv ON sv.key = c.v
       LEFT JOIN ov ON ov.u = c.u AND ov.v = c.v)
SELECT u, v, round(jaccard, 6) AS jaccard FROM sc WHERE jaccard >= {threshold}"""


# ---------------------------------------------------------------- projection

def _gauss(seed, t, j, item) -> str:
    h = f"md5(concat_ws(':', '{seed}', {t}::VARCHAR, {j}::VARCHAR, {item}::VARCHAR))"
    u1 = f"((('0x' || substr({h}, 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / {TWO52}::DOUBLE)"
    u2 = f"((('0x' || substr({h}, 14, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / {TWO52}::DOUBLE)"
    return f"(sqrt(-2.0::DOUBLE * ln({u1})) * cos({TWO_PI}::DOUBLE * {u2}))"


def _planes(items_sql: str, bits: int, name="planes", tables: int = Q.RP_TABLES) -> str:
    return f"""{name} AS (
  SELECT item, t::INTEGER AS tbl, j::INTEGER AS bit, {_gauss(Q.SEED, 't', 'j', 'item')} AS w
  FROM (SELECT DISTINCT item FROM ({items_sql})) i, range({tables}) tt(t), range({bits}) jj(j))"""


def _sparse_sig(vec: str, name: str, bits: int) -> str:
    return f"""{_planes(f'SELECT item FROM {vec}', bits, name + '_pl')},
{name}_p AS (
  SELECT x.key, p.tbl, p.bit, sum(x.w::DOUBLE * p.w) AS pr
  FROM {vec} x JOIN {name}_pl p ON p.item = x.item GROUP BY x.key, p.tbl, p.bit),
{name} AS (
  SELECT key, tbl, string_agg(CASE WHEN pr > 0 THEN '1' ELSE '0' END, '' ORDER BY bit) AS bucket
  FROM {name}_p GROUP BY key, tbl)"""


def _rp_cand(sig: str, name: str) -> str:
    return f"""{name} AS (
  SELECT DISTINCT a.key AS u, b.key AS v FROM {sig} a JOIN {sig} b
    ON a.tbl = b.tbl AND a.bucket = b.bucket AND a.key < b.key)"""


def _vec_sig() -> str:
    return f"""vx AS (
  SELECT vec_id AS key, unnest(range(len(embedding))) AS d, unnest(embedding)::DOUBLE AS x
  FROM embeddings),
{_planes('SELECT d AS item FROM vx', Q.VEC_BITS, 'vpl')},
vproj AS (SELECT vx.key, vpl.tbl, vpl.bit, sum(vx.x * vpl.w) AS pr
          FROM vx JOIN vpl ON vpl.item = vx.d GROUP BY vx.key, vpl.tbl, vpl.bit),
vsig AS (
  SELECT p.key, p.tbl, string_agg(CASE WHEN pr > 0 THEN '1' ELSE '0' END, '' ORDER BY bit) AS bucket
  FROM vproj p GROUP BY p.key, p.tbl),
vsig_l AS (SELECT s.key, s.tbl, s.bucket, e.label FROM vsig s JOIN embeddings e ON e.vec_id = s.key)"""


def _vec_scores() -> str:
    return _vec_sig() + ",\n" + _rp_cand("vsig", "vcand") + """,
vsc AS (
  SELECT c.u, c.v,
         list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
           / sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])
                  * list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS cosine
  FROM vcand c JOIN embeddings a ON a.vec_id = c.u JOIN embeddings b ON b.vec_id = c.v)"""


def _cosine_pairs(binary: bool, threshold: float) -> str:
    if binary:
        vec = """vec AS (SELECT DISTINCT "user" AS key, item, 1::BIGINT AS w FROM ev_tr)"""
    else:
        vec = """vec AS (SELECT * FROM (
                 SELECT "user" AS key, item, trunc(arg_max(rating, event_id))::BIGINT AS w
                 FROM ev_tr GROUP BY "user", item) WHERE w <> 0)"""
    bits = Q.DCS_BITS if binary else Q.CS_BITS
    return _with(_ev_triples(), vec, _sparse_sig("vec", "rsig", bits), _rp_cand("rsig", "rcand"),
                 f"""nrm AS (SELECT key, sum(w::DOUBLE * w) AS nn FROM vec GROUP BY key),
dots AS (SELECT c.u, c.v, sum(x.w::DOUBLE * y.w) AS dot FROM rcand c
           JOIN vec x ON x.key = c.u JOIN vec y ON y.key = c.v AND y.item = x.item
         GROUP BY c.u, c.v),
sc AS (SELECT c.u, c.v, coalesce(d.dot, 0.0) / sqrt(nu.nn * nv.nn) AS cosine
       FROM rcand c JOIN nrm nu ON nu.key = c.u JOIN nrm nv ON nv.key = c.v
       LEFT JOIN dots d ON d.u = c.u AND d.v = c.v)""") + \
        f"SELECT u, v, round(cosine, 6) AS cosine FROM sc WHERE cosine >= {threshold}"


# ---------------------------------------------------------------- exact pairs

def _vec_cte(binary: bool) -> str:
    if binary:
        return """vec AS (SELECT DISTINCT "user" AS key, item, 1::BIGINT AS w FROM ev_tr)"""
    return """vec AS (SELECT * FROM (
                 SELECT "user" AS key, item, trunc(arg_max(rating, event_id))::BIGINT AS w
                 FROM ev_tr GROUP BY "user", item) WHERE w <> 0)"""


def _exact_jaccard(sets: str, reps: str, name: str) -> str:
    """All pairs of representatives that share an element, with their Jaccard."""
    return f"""{name}_r AS (SELECT * FROM {sets} WHERE key IN (SELECT rep FROM {reps})),
{name}_n AS (SELECT key, count(*) AS n FROM {name}_r GROUP BY key),
{name} AS (
  SELECT o.u, o.v, o.o::DOUBLE / (a.n + b.n - o.o) AS score
  FROM (SELECT x.key AS u, y.key AS v, count(*) AS o FROM {name}_r x JOIN {name}_r y
          ON x.element = y.element AND x.key < y.key GROUP BY x.key, y.key) o
  JOIN {name}_n a ON a.key = o.u JOIN {name}_n b ON b.key = o.v)"""


def _exact_cosine(name: str, vec: str = "vec") -> str:
    """All pairs of representatives of equal vectors that share a coordinate, with their cosine."""
    return f"""{name}_g AS (
  SELECT min(key) AS rep FROM (SELECT key, string_agg(item || ':' || w, ',' ORDER BY item) AS m FROM {vec} GROUP BY key) GROUP BY m),
{name}_r AS (SELECT * FROM {vec} WHERE key IN (SELECT rep FROM {name}_g)),
{name}_n AS (SELECT key, sum(w::DOUBLE * w) AS nn FROM {name}_r GROUP BY key),
{name} AS (
  SELECT d.u, d.v, d.dot / sqrt(a.nn * b.nn) AS score
  FROM (SELECT x.key AS u, y.key AS v, sum(x.w::DOUBLE * y.w) AS dot FROM {name}_r x JOIN {name}_r y
          ON x.item = y.item AND x.key < y.key GROUP BY x.key, y.key) d
  JOIN {name}_n a ON a.key = d.u JOIN {name}_n b ON b.key = d.v)"""


# ---------------------------------------------------------------- multi-probe, forest, quality

def _draw(*names: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(f'({n})::VARCHAR' for n in (str(Q.SEED), *names))})), 1, 8))::BIGINT"


def _hadamard(vec: str, name: str, bits: int, tables: int, probes: int) -> str:
    """Own bucket and probes by the definition: the sign of each plane over all items, least sure bits by size."""
    width, m = probing.WIDTH, probing.UNSURE
    return f"""{name}_x AS (
  SELECT key, {_draw("'at'", "item")} % {width} AS at,
         sum(w * CASE WHEN {_draw("'turn'", "item")} % 2 = 1 THEN 1 ELSE -1 END)::BIGINT AS x
  FROM {vec} WHERE w <> 0 GROUP BY ALL),
{name}_s AS (SELECT t, j, CASE WHEN {_draw("'sign'", "t", "j")} % 2 = 1 THEN 1 ELSE -1 END AS s
             FROM range({tables}) a(t), range({width}) b(j)),
{name}_r AS (SELECT t, b, ({_draw("'row'", "t")} + 37 * b) % {width} AS r FROM range({tables}) x(t), range({bits}) y(b)),
{name}_p AS (
  SELECT x.key, r.t, r.b, sum(x.x * s.s * (1 - 2 * (bit_count(r.r & x.at)::INTEGER % 2)))::BIGINT AS p
  FROM {name}_x x JOIN {name}_s s ON s.j = x.at JOIN {name}_r r ON r.t = s.t GROUP BY x.key, r.t, r.b),
{name}_o AS (SELECT key, t, sum(CASE WHEN p > 0 THEN 1::BIGINT << ({bits - 1} - b)::INTEGER ELSE 0 END)::BIGINT AS own FROM {name}_p GROUP BY key, t),
{name}_l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key, t ORDER BY abs(p), b) - 1 AS i FROM {name}_p) WHERE i < {m}),
{name}_c AS (
  SELECT key, t, n, sum(CASE WHEN (n >> i::INTEGER) & 1 = 1 THEN p * p ELSE 0 END) AS cost,
         sum(CASE WHEN (n >> i::INTEGER) & 1 = 1 THEN 1::BIGINT << ({bits - 1} - b)::INTEGER ELSE 0 END)::BIGINT AS flip
  FROM {name}_l, range({2 ** m}) z(n) GROUP BY key, t, n),
{name} AS (
  SELECT key, t::INTEGER AS tbl, (probe - 1)::INTEGER AS probe, xor(own, flip) AS bucket
  FROM (SELECT *, row_number() OVER (PARTITION BY key, t ORDER BY cost, n) AS probe FROM {name}_c) JOIN {name}_o USING (key, t)
  WHERE probe <= {1 + probes})"""


def _probed(sig: str, name: str) -> str:
    return f"""{name} AS (
  SELECT DISTINCT least(p.key, o.key) AS u, greatest(p.key, o.key) AS v
  FROM {sig} p JOIN {sig} o ON p.tbl = o.tbl AND p.bucket = o.bucket AND o.probe = 0 AND p.key <> o.key)"""


def _multiprobe_pairs(binary: bool, threshold: float, setting: tuple) -> str:
    return _with(_ev_triples(), _vec_cte(binary), _hadamard("vec", "hsig", *setting), _probed("hsig", "cand"),
                 _scored_cosine("cand", "sc")) + f"SELECT u, v, round(score, 6) AS cosine FROM sc WHERE score >= {threshold}"


def _scored_cosine(cand: str, name: str, vec: str = "vec") -> str:
    return f"""{name}_m AS (SELECT key, sum(w::DOUBLE * w) AS nn FROM {vec} GROUP BY key),
{name} AS (
  SELECT c.u, c.v, coalesce(d.dot, 0.0::DOUBLE) / sqrt(a.nn * b.nn) AS score FROM {cand} c
  JOIN {name}_m a ON a.key = c.u JOIN {name}_m b ON b.key = c.v
  LEFT JOIN (SELECT c.u, c.v, sum(x.w::DOUBLE * y.w) AS dot FROM {cand} c JOIN {vec} x ON x.key = c.u
             JOIN {vec} y ON y.key = c.v AND y.item = x.item GROUP BY c.u, c.v) d ON d.u = c.u AND d.v = c.v)"""


def _scored_jaccard(cand: str, name: str, sets: str) -> str:
    return f"""{name}_m AS (SELECT key, count(*) AS n FROM {sets} GROUP BY key),
{name} AS (
  SELECT c.u, c.v, coalesce(d.o, 0)::DOUBLE / (a.n + b.n - coalesce(d.o, 0)) AS score FROM {cand} c
  JOIN {name}_m a ON a.key = c.u JOIN {name}_m b ON b.key = c.v
  LEFT JOIN (SELECT c.u, c.v, count(*) AS o FROM {cand} c JOIN {sets} x ON x.key = c.u
             JOIN {sets} y ON y.key = c.v AND y.element = x.element GROUP BY c.u, c.v) d ON d.u = c.u AND d.v = c.v)"""


def _bands_of(method: str, exact: str, scored: str, threshold: float, chance: str) -> str:
    return f"""(
WITH e AS (SELECT u, v, round(score, 6) AS score FROM {exact} WHERE score >= {threshold}),
c AS (SELECT u, v, round(score, 6) AS score FROM {scored}),
t AS (SELECT floor(e.score * 20)::INTEGER AS b, count(*) AS pairs, count(c.u) AS found, avg({chance}) AS predicted
      FROM e LEFT JOIN c ON c.u = e.u AND c.v = e.v GROUP BY ALL),
m AS (SELECT floor(score * 20)::INTEGER AS b, count(*) AS candidates FROM c GROUP BY ALL)
SELECT '{method}' AS method, round(b / 20, 2) AS band, coalesce(pairs, 0) AS pairs, coalesce(candidates, 0) AS candidates, coalesce(found, 0) AS found,
       round(found / pairs, 6) AS recall, round(coalesce(candidates, 0) / nullif(sum(coalesce(candidates, 0)) OVER (), 0), 6) AS share,
       round(predicted, 6) AS predicted
FROM t FULL JOIN m USING (b))"""


def _lsh_quality() -> str:
    agree = "(1.0::DOUBLE - acos(greatest(least(e.score, 1.0::DOUBLE), -1.0::DOUBLE)) / pi())"
    rp = lambda bits: f"1.0::DOUBLE - pow(1.0::DOUBLE - pow({agree}, {bits}), {Q.RP_TABLES})"
    mh = f"1.0::DOUBLE - pow(1.0::DOUBLE - pow(e.score, {Q.ROWS}), {Q.BANDS})"
    ctes = [_perms(), _ev_index(), EV_REPS, _cand("ev_idx", "jc", "ev_reps"), _exact_jaccard("ev_sets", "ev_reps", "jx"),
            _scored_jaccard("jc", "js", "ev_sets"),
            _doc_index(), DOC_REPS, _cand("doc_idx", "dc", "doc_reps"), _exact_jaccard("doc_idx_s", "doc_reps", "dx"),
            _scored_jaccard("dc", "ds", "doc_idx_s")]
    parts = [_bands_of("js", "jx", "js", Q.JS_THRESHOLD, mh), _bands_of("documents", "dx", "ds", Q.DOC_THRESHOLD, mh)]
    for m, binary, t, bits, setting in (("cs", False, Q.CS_THRESHOLD, Q.CS_BITS, Q.CS_PROBE), ("dcs", True, Q.DCS_THRESHOLD, Q.DCS_BITS, Q.DCS_PROBE)):
        ctes += [_vec_cte(binary).replace("vec AS", f"{m}_v AS", 1), _exact_cosine(f"{m}_e", f"{m}_v"),
                 _sparse_sig(f"{m}_e_r", f"{m}_s", bits), _rp_cand(f"{m}_s", f"{m}_p"), _scored_cosine(f"{m}_p", f"{m}_ps", f"{m}_e_r"),
                 _hadamard(f"{m}_e_r", f"{m}_h", *setting), _probed(f"{m}_h", f"{m}_q"), _scored_cosine(f"{m}_q", f"{m}_qs", f"{m}_e_r")]
        parts += [_bands_of(m, f"{m}_e", f"{m}_ps", t, rp(bits)), _bands_of(f"{m} multi-probe", f"{m}_e", f"{m}_qs", t, "NULL::DOUBLE")]
    return _with(*ctes) + "\nUNION ALL\n".join(f"SELECT * FROM {p}" for p in parts)


def _forest() -> str:
    """The k nearest among the keys that share the longest prefix under which enough lie."""
    return _with(f"""vx AS (
  SELECT vec_id AS key, unnest(range(len(embedding))) AS d, unnest(embedding)::DOUBLE AS x FROM embeddings),
{_planes('SELECT d AS item FROM vx', Q.TREE_BITS, 'vpl', Q.TREES)},
vproj AS (SELECT vx.key, vpl.tbl, vpl.bit, sum(vx.x * vpl.w) AS pr FROM vx JOIN vpl ON vpl.item = vx.d GROUP BY vx.key, vpl.tbl, vpl.bit),
sig AS (SELECT key, tbl, string_agg(CASE WHEN pr > 0 THEN '1' ELSE '0' END, '' ORDER BY bit) AS bucket FROM vproj GROUP BY key, tbl),
pre AS (SELECT key, tbl, d, substr(bucket, 1, d::INTEGER) AS prefix FROM sig, range({Q.TREE_BITS + 1}) x(d)),
cnt AS (SELECT key, d, max(n) AS most, sum(n) AS every FROM (SELECT *, count(*) OVER (PARTITION BY tbl, d, prefix) AS n FROM pre) GROUP BY key, d),
dep AS (SELECT key, coalesce(max(d) FILTER (most > {Q.TOP_K} AND every >= {Q.FOREST_CANDIDATES}), 0) AS d FROM cnt GROUP BY key),
met AS (SELECT DISTINCT q.key AS q, i.key FROM dep JOIN pre q ON q.key = dep.key AND q.d = dep.d
        JOIN pre i ON i.tbl = q.tbl AND i.d = q.d AND i.prefix = q.prefix AND i.key <> q.key),
sc AS (
  SELECT met.q, met.key, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
           / sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]) * list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS cosine
  FROM met JOIN embeddings a ON a.vec_id = met.q JOIN embeddings b ON b.vec_id = met.key),
rk AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY cosine DESC, key) AS rank FROM sc)""") + \
        f"SELECT q, key, round(cosine, 6) AS cosine, rank::INTEGER AS rank FROM rk WHERE rank <= {Q.TOP_K}"


# ---------------------------------------------------------------- statements

def _ev_hits_sql() -> str:
    return _with(_perms(), _ev_index(),
                 "hits AS (SELECT DISTINCT p.key AS q, i.key AS key FROM ev_idx p "
                 "JOIN ev_idx i ON i.band = p.band AND i.bucket = p.bucket)")


def build() -> dict[str, str]:
    s: dict[str, str] = {}
    s["ratings_scan"] = _with(_ev_triples()) + 'SELECT "user", item, rating FROM ev_tr'
    s["user_item_projection"] = ('SELECT o_custkey AS "user", l_partkey AS item '
                                 'FROM lineitem JOIN orders ON l_orderkey = o_orderkey')
    s["sha1_hash32"] = _with(_doc_sets()) + \
        f"SELECT element, {_hv('element')} AS hv FROM (SELECT DISTINCT element FROM doc_sets)"
    s["user_item_sets"] = _with(
        _ev_ratings(), 'st AS (SELECT DISTINCT "user", item::VARCHAR AS element FROM ev_r)') + \
        ('SELECT st."user", st.element, n.set_size FROM st JOIN '
         '(SELECT "user", count(*) AS set_size FROM st GROUP BY "user") n ON n."user" = st."user"')
    s["ratings_per_user"] = _with(_ev_triples()) + \
        'SELECT "user", count(*) AS n_ratings FROM ev_tr GROUP BY "user"'
    s["feature_sample"] = _with(_ev_ratings(), f"""smp AS (
  SELECT item FROM (SELECT DISTINCT item FROM ev_r)
  ORDER BY md5(concat_ws(':', '{Q.SEED}', item::VARCHAR)), item LIMIT {Q.FEATURES})""") + \
        'SELECT "user", item, rating FROM ev_r WHERE item IN (SELECT item FROM smp)'
    s["rating_vectors"] = _with(_ev_triples()) + """SELECT key, item, w FROM (
  SELECT "user" AS key, item, trunc(arg_max(rating, event_id))::BIGINT AS w
  FROM ev_tr GROUP BY "user", item) WHERE w <> 0"""
    s["binary_vectors"] = _with(_ev_triples()) + \
        'SELECT DISTINCT "user" AS key, item, 1::BIGINT AS w FROM ev_tr'
    s["domain_filter"] = _with(_ev_triples()) + \
        f'SELECT "user", item, rating FROM ev_tr WHERE item BETWEEN {Q.DOMAIN[0]} AND {Q.DOMAIN[1]}'
    s["parse_points"] = ("SELECT vec_id AS key, len(embedding)::INTEGER AS dims, "
                         "round(list_sum(embedding::DOUBLE[]), 6) AS vsum, label::VARCHAR AS extra "
                         "FROM embeddings")
    s["minhash_signature"] = _with(_perms(), _doc_sets(), _sig("doc_sets", "sig")) + \
        "SELECT key, perm, v FROM sig"
    s["minhash_signature_limbs"] = s["minhash_signature"]
    s["npy_ratings"] = s["ratings_scan"]
    s["minhash_rollup"] = _with(_perms(), _baskets(), _sig("bk_sets", "bk_sig"), """lv AS (
  SELECT c_custkey AS key, r_name AS region, n_name AS nation
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""") + """
SELECT 2 AS level, region, nation, key, perm, v FROM bk_sig JOIN lv USING (key)
UNION ALL SELECT 1, region, nation, -1, perm, min(v) FROM bk_sig JOIN lv USING (key) GROUP BY region, nation, perm
UNION ALL SELECT 0, region, '', -1, perm, min(v) FROM bk_sig JOIN lv USING (key) GROUP BY region, perm"""
    empty = _with(_perms(), _baskets(), _sig("bk_sets", "bk_sig"), f"""es AS (
  SELECT c.c_custkey AS key, p.perm, coalesce(s.v, {M32}) AS v
  FROM customer c CROSS JOIN perms p LEFT JOIN bk_sig s ON s.key = c.c_custkey AND s.perm = p.perm)""")
    s["empty_signature"] = empty + "SELECT key, perm, v FROM es"
    s["minhash_is_empty"] = empty + f"SELECT key, bool_and(v = {M32}) AS is_empty FROM es GROUP BY key"
    s["minhash_jaccard"] = _with(_perms(), _ev_index(), _cand("ev_idx", "cand")) + """
SELECT c.u, c.v, round(avg(CASE WHEN a.v = b.v THEN 1.0 ELSE 0.0 END), 6) AS jaccard_est
FROM cand c JOIN ev_sig a ON a.key = c.u JOIN ev_sig b ON b.key = c.v AND b.perm = a.perm
GROUP BY c.u, c.v"""
    s["minhash_merge"] = _with(_perms(), _ev_index(), _cand("ev_idx", "cand")) + f"""
SELECT c.u, c.v, round(count(*) / sum(least(a.v, b.v) / {M32}.0) - 1.0, 6) AS union_card
FROM cand c JOIN ev_sig a ON a.key = c.u JOIN ev_sig b ON b.key = c.v AND b.perm = a.perm
GROUP BY c.u, c.v"""
    s["minhash_cardinality"] = _with(_perms(), _doc_sets(), _sig("doc_sets", "sig")) + \
        f"SELECT key, round(count(*) / sum(v / {M32}.0) - 1.0, 6) AS card_est FROM sig GROUP BY key"
    s["minhash_union"] = _with(_perms(), _baskets(), _sig("bk_sets", "bk_sig")) + """
SELECT c.c_nationkey AS "group", s.perm, min(s.v) AS v
FROM bk_sig s JOIN customer c ON c.c_custkey = s.key GROUP BY c.c_nationkey, s.perm"""
    s["minhash_digest"] = _with(_perms(), _doc_sets(), _sig("doc_sets", "sig")) + \
        "SELECT key, string_agg(v::VARCHAR, ',' ORDER BY perm) AS hashvalues FROM sig GROUP BY key"
    s["identical_signatures"] = _with(_perms(), _doc_sets(), _sig("doc_sets", "sig"), """dg AS (
  SELECT key, string_agg(v::VARCHAR, ',' ORDER BY perm) AS d FROM sig GROUP BY key),
grp AS (SELECT d, min(key) AS rep, count(*) AS group_size FROM dg GROUP BY d HAVING count(*) > 1)""") + \
        "SELECT dg.key, grp.rep, grp.group_size FROM dg JOIN grp ON grp.d = dg.d"
    s["band_buckets"] = _with(_perms(), _doc_index()) + "SELECT key, band, bucket FROM doc_idx"
    s["index_insert"] = s["band_buckets"]
    s["index_duplicates"] = _with(_doc_sets("a_s")) + """
SELECT doc_id AS key FROM labels WHERE doc_id IN (SELECT key FROM a_s)
UNION SELECT doc_id FROM labels GROUP BY doc_id HAVING count(*) > 1"""
    probe_de = _doc_index("de_idx", "lang = 'de'")
    s["index_query"] = _with(_perms(), _doc_index(), probe_de) + """
SELECT DISTINCT p.key AS q, i.key AS key FROM de_idx p
  JOIN doc_idx i ON i.band = p.band AND i.bucket = p.bucket"""
    s["index_query_bands"] = _with(_perms(), _doc_index(), probe_de) + f"""
SELECT DISTINCT p.key AS q, i.key AS key FROM de_idx p
  JOIN doc_idx i ON i.band = p.band AND i.bucket = p.bucket
WHERE p.band < {Q.QUERY_BANDS}"""
    alike = """{0}_reps AS (
  SELECT key, min(key) OVER (PARTITION BY buckets) AS rep
  FROM (SELECT key, string_agg(bucket, ',' ORDER BY band) AS buckets FROM {0}_idx GROUP BY key))"""
    both = _with(_perms(), _doc_index(), probe_de, alike.format("de"), alike.format("doc"))
    s["index_query_groups"] = both + """
SELECT DISTINCT p.key AS q, i.key AS key FROM de_idx p
  JOIN doc_idx i ON i.band = p.band AND i.bucket = p.bucket
WHERE p.key IN (SELECT rep FROM de_reps) AND i.key IN (SELECT rep FROM doc_reps)"""
    s["index_query_members"] = both + """
SELECT 'probe' AS side, key, rep FROM de_reps UNION ALL SELECT 'index', key, rep FROM doc_reps"""
    s["stored_index_query"] = s["index_query"]
    s["stored_index_lookup"] = _with(_perms(), _doc_index()) + """
SELECT c.doc_id AS key, coalesce(l.buckets, '') AS buckets
FROM (SELECT DISTINCT doc_id FROM labels) c LEFT JOIN (
  SELECT key, string_agg(bucket, ',' ORDER BY band) AS buckets FROM doc_idx GROUP BY key) l ON l.key = c.doc_id"""
    s["index_contains"] = _with(_baskets()) + \
        "SELECT DISTINCT c_custkey AS key FROM customer WHERE c_custkey IN (SELECT key FROM bk_sets)"
    s["index_remove"] = _with(_perms(), _doc_index()) + """
SELECT key, band, bucket FROM doc_idx
WHERE key NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')"""
    s["index_is_empty"] = _with(_perms(), _doc_index()) + \
        f"SELECT count(DISTINCT band) < {Q.BANDS} AS is_empty FROM doc_idx"
    s["bucket_counts"] = _with(_perms(), _doc_index()) + \
        "SELECT band, bucket, count(*) AS n_keys FROM doc_idx GROUP BY band, bucket"
    s["bucket_subset_counts"] = _with(_perms(), _doc_index()) + """
SELECT band, bucket, count(*) AS n_keys FROM doc_idx
WHERE key IN (SELECT doc_id FROM documents WHERE lang = 'de') GROUP BY band, bucket"""
    s["js_candidate_pairs"] = _with(_perms(), _doc_index(), DOC_REPS, _cand("doc_idx", "cand", "doc_reps")) + \
        "SELECT u, v FROM cand"
    s["copy_groups"] = _with(DOC_REPS) + "SELECT key, rep FROM doc_reps"
    s["set_copy_groups"] = _with(_ev_sets(), EV_REPS) + "SELECT key, rep FROM ev_reps"
    s["index_lookup"] = _with(_perms(), _bk_index()) + """
SELECT c.c_custkey AS key, coalesce(l.buckets, '') AS buckets
FROM (SELECT DISTINCT c_custkey FROM customer) c LEFT JOIN (
  SELECT key, string_agg(bucket, ',' ORDER BY band) AS buckets FROM bk_idx GROUP BY key) l
  ON l.key = c.c_custkey"""
    s["index_stats"] = _with(_perms(), _doc_index()) + """
SELECT count(DISTINCT key) AS n_keys, count(DISTINCT (band, bucket)) AS n_buckets,
       count(*) AS n_rows FROM doc_idx"""
    s["multimap_list_vs_set"] = """
SELECT user_id AS key, count(event_type) AS list_len, count(DISTINCT event_type) AS set_size,
       arg_min(event_type, event_id) AS first_value FROM events GROUP BY user_id"""
    s["multimap_remove"] = """
WITH firsts AS (
  SELECT user_id, event_type, min(event_id) AS event_id FROM events
  WHERE (user_id, event_type) IN (SELECT user_id, event_type FROM events WHERE value > 40)
  GROUP BY user_id, event_type)
SELECT e.user_id, e.event_type, e.event_id FROM events e
WHERE (e.user_id, e.event_type, e.event_id) NOT IN (SELECT user_id, event_type, event_id FROM firsts)"""
    s["hyperplanes"] = _with(_ev_triples(), _planes("SELECT item FROM ev_tr", Q.DCS_BITS)) + \
        "SELECT item, tbl, bit, round(w, 6) AS w FROM planes"
    s["saved_planes"] = _with(_ev_triples(), _planes("SELECT item FROM ev_tr", Q.CS_BITS, tables=2)) + \
        "SELECT item, tbl, bit, round(w, 6) AS w FROM planes"
    s["rp_signature"] = _with(_ev_triples(), 'bv AS (SELECT DISTINCT "user" AS key, item, 1::BIGINT AS w FROM ev_tr)',
                              _sparse_sig("bv", "rsig", Q.DCS_BITS)) + "SELECT key, tbl, bucket FROM rsig"
    s["rp_index"] = _with(_vec_sig()) + "SELECT key, tbl, bucket, label FROM vsig_l"
    s["rp_candidates"] = _with(_vec_sig(), _rp_cand("vsig", "vcand")) + "SELECT u, v FROM vcand"
    s["cosine_score"] = _with(_vec_scores()) + "SELECT u, v, round(cosine, 6) AS cosine FROM vsc"
    s["cosine_threshold"] = _with(_vec_scores()) + \
        f"SELECT u, v, round(cosine, 6) AS cosine FROM vsc WHERE cosine >= {Q.VEC_THRESHOLD}"
    s["cosine_topk"] = _with(_vec_scores(), """hits AS (
  SELECT u AS q, v AS key, cosine FROM vsc UNION ALL SELECT v AS q, u AS key, cosine FROM vsc),
rk AS (SELECT q, key, cosine, row_number() OVER (PARTITION BY q ORDER BY cosine DESC, key ASC) AS rank
       FROM hits WHERE cosine IS NOT NULL)""") + \
        f"SELECT q, key, round(cosine, 6) AS cosine, rank::INTEGER AS rank FROM rk WHERE rank <= {Q.TOP_K}"
    s["rp_probe_topk"] = _with(_vec_sig(), f"""hits AS (
  SELECT DISTINCT p.key AS q, i.key FROM vsig_l p JOIN vsig_l i ON i.tbl = p.tbl AND i.bucket = p.bucket
  WHERE p.label = {Q.PROBE_LABEL}),
sc AS (
  SELECT h.q, h.key, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
           / sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])
                  * list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS cosine
  FROM hits h JOIN embeddings a ON a.vec_id = h.q JOIN embeddings b ON b.vec_id = h.key),
rk AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY cosine DESC, key) AS rank
       FROM sc WHERE cosine >= {Q.PROBE_THRESHOLD})""") + \
        f"SELECT q, key, round(cosine, 6) AS cosine, rank::INTEGER AS rank FROM rk WHERE rank <= {Q.TOP_K}"
    s["cs_pairs"] = _cosine_pairs(False, Q.CS_THRESHOLD)
    s["dcs_pairs"] = _cosine_pairs(True, Q.DCS_THRESHOLD)
    s["pair_lines"] = ("SELECT DISTINCT concat_ws(', ', u::VARCHAR, v::VARCHAR) AS value FROM ("
                       + s["dcs_pairs"] + ")")
    hits = _ev_hits_sql()
    s["canonical_pairs"] = hits + "SELECT least(q, key) AS u, greatest(q, key) AS v FROM hits WHERE q <> key"
    s["distinct_pairs"] = hits + \
        "SELECT DISTINCT least(q, key) AS u, greatest(q, key) AS v FROM hits WHERE q <> key"
    s["hit_count"] = hits + "SELECT count(*) AS n_hits FROM hits WHERE q <> key"
    s["users_with_matches"] = hits + "SELECT DISTINCT q FROM hits WHERE q <> key"
    s["sampled_pairs"] = s["js_candidate_pairs"] + f"""
WHERE ('0x' || substr(md5(concat_ws(':', '{Q.SEED}', u::VARCHAR, v::VARCHAR)), 1, 8))::BIGINT
      < {int(Q.SAMPLE_RATE * (1 << 32))}"""
    s["stream_signature"] = _with(_perms(), _ev_sets(), _sig("ev_sets", "sig")) + \
        "SELECT key, perm, v FROM sig"
    s["stream_index"] = s["band_buckets"]
    s["stream_keyed_index"] = _with(_perms(), _doc_index(where="lang IS DISTINCT FROM 'fr'")) + \
        "SELECT key, band, bucket FROM doc_idx"
    s["stream_rejects"] = f"""
WITH d AS (SELECT doc_id, lang, regexp_matches(coalesce(text, ''), '[^{WS[1:-2]}]') AS words FROM documents)
SELECT doc_id AS key, CASE lang WHEN 'de' THEN 1 ELSE 0 END::BIGINT AS seq,
       CASE lang WHEN 'de' THEN 'key is there' ELSE 'no such key' END AS reason FROM d WHERE words AND lang IN ('de', 'es')
UNION ALL SELECT doc_id, i, CASE WHEN op = 'insert' THEN 'no elements' ELSE 'no such key' END
FROM (SELECT doc_id, unnest(range(len(o))) AS i, unnest(o) AS op FROM (
  SELECT doc_id, CASE lang WHEN 'fr' THEN ['insert', 'remove'] WHEN 'de' THEN ['insert', 'insert']
                           WHEN 'es' THEN ['remove', 'insert', 'remove', 'insert'] ELSE ['insert'] END AS o FROM d WHERE NOT words))"""
    s["js_pairs"] = _with(_perms(), _ev_index(), EV_REPS, _cand("ev_idx", "cand", "ev_reps"),
                          _jaccard_verified("ev_sets", "cand", Q.JS_THRESHOLD))
    s["doc_near_duplicates"] = _with(_perms(), _doc_index(), DOC_REPS, _cand("doc_idx", "cand", "doc_reps"),
                                     _jaccard_verified("doc_idx_s", "cand", Q.DOC_THRESHOLD))
    at_least = lambda name, score, t: f"SELECT u, v, round(score, 6) AS {score} FROM {name} WHERE score >= {t}"
    s["exact_js_pairs"] = _with(_ev_sets(), EV_REPS, _exact_jaccard("ev_sets", "ev_reps", "ex")) + \
        at_least("ex", "jaccard", Q.JS_THRESHOLD)
    s["exact_doc_pairs"] = _with(_doc_sets(), DOC_REPS, _exact_jaccard("doc_sets", "doc_reps", "ex")) + \
        at_least("ex", "jaccard", Q.DOC_THRESHOLD)
    s["exact_cs_pairs"] = _with(_ev_triples(), _vec_cte(False), _exact_cosine("ex")) + at_least("ex", "cosine", Q.CS_THRESHOLD)
    s["exact_dcs_pairs"] = _with(_ev_triples(), _vec_cte(True), _exact_cosine("ex")) + at_least("ex", "cosine", Q.DCS_THRESHOLD)
    s["hadamard_signature"] = _with(_ev_triples(), _vec_cte(True), _hadamard("vec", "hsig", *Q.DCS_PROBE)) + \
        "SELECT key, tbl, probe, bucket FROM hsig"
    s["multiprobe_cs_pairs"] = _multiprobe_pairs(False, Q.CS_THRESHOLD, Q.CS_PROBE)
    s["multiprobe_dcs_pairs"] = _multiprobe_pairs(True, Q.DCS_THRESHOLD, Q.DCS_PROBE)
    s["forest_topk"] = _forest()
    s["lsh_quality"] = _lsh_quality()
    return s


ORACLE: dict[str, str] = build()
