"""DuckDB SQL for the queries that SQL can express: substring dedup, near-duplicate classes, sharding, mixing, hard negatives, vector codes, exact neighbours (what
the search gives while its table falls into one part), and what is plain in two others: counts of base spans, edited texts.
Draws are MD5, which any engine can make; a CRC-32 is a fold over bytes."""

from __future__ import annotations

from quiltgraph.llm import mixing, negatives, sharding, vector_codes


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def op1_sql() -> str:
    """All windows as text, the first place of each, the words that later ones cover."""
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, {WORDS} AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d WHERE len(w) >= 20),
k AS MATERIALIZED (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS words FROM x),
f AS (SELECT words, min((doc_id, i)) AS first FROM k GROUP BY words HAVING count(*) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM k JOIN f USING (words) WHERE (doc_id, i) > first),
n AS (SELECT doc_id, list(p) AS gone FROM g GROUP BY doc_id),
r AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
             CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda p: NOT list_contains(gone, p)), lambda p: w[p]) END AS kept
      FROM d LEFT JOIN n ON d.doc_id = n.doc_id)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM r"""


def op2_sql() -> str:
    """All pairs of texts that share a shingle, their Jaccard similarity, and components by recursion."""
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {WORDS} AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 3, 2))) AS i, w FROM d WHERE len(w) > 0),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM x),
z AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN z y ON y.doc_id = a JOIN z q ON q.doc_id = b WHERE p.n >= 0.8 * (y.n + q.n - p.n)),
e AS MATERIALIZED (SELECT a, b FROM l UNION SELECT b, a FROM l),
c(node, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, c.root FROM c JOIN e ON e.a = c.node)
SELECT doc_id, min(root) AS class_id FROM d JOIN c ON c.node = doc_id GROUP BY doc_id"""


def _unit(key: str, node: str) -> str:
    return f"((('0x' || substr(md5({key} || '/{node}'), 1, 12))::BIGINT::DOUBLE + 0.5) / {float(2**48)!r})"


def _least(key: str, children: list[tuple[str, float, int]]) -> str:
    if len(children) == 1:
        return str(children[0][2])
    names = ", ".join(f"struct_pack(d := -ln({_unit(key, n)}) / {w!r}, v := {v})" for n, w, v in children)
    return f"(list_sort([{names}])[1]).v"


def _tree(tree: sharding.HashTree) -> tuple[str, str, str]:
    """Region, rack and shard expressions; each uses the one before by its name."""
    racks = [(r, k, s) for r, region in enumerate(tree.regions) for k, s in enumerate(region)]
    region = _least("k", [(f"r{r}", tree.weight(s for x in c for s in x), r) for r, c in enumerate(tree.regions)] + [(f"g{s}", w, -1 - s) for s, w, *_ in tree.grafts])
    rack, at = "CASE WHEN {region} < 0 THEN {region}", 0
    for r, content in enumerate(tree.regions):
        rack += f" WHEN {{region}} = {r} THEN " + _least("k", [(f"r{r}k{k}", tree.weight(s), at + k) for k, s in enumerate(content)])
        at += len(content)
    leaf = "CASE WHEN {rack} < 0 THEN -1 - {rack}"
    for i, (r, k, shards) in enumerate(racks):
        leaf += f" WHEN {{rack}} = {i} THEN " + _least("k", [(f"r{r}k{k}s{s}", tree.weights.get(s, 1.0), s) for s in shards])
    return region, rack + " END", leaf + " END"


def op7_sql() -> str:
    weights = f"[{', '.join(map(repr, mixing.WEIGHTS))}]"
    first, last = (f"[{', '.join(repr(s[k]) for s in mixing.SCHEDULES)}]" for k in (0, 1))
    n = f"greatest(1, (((SELECT count(*) FROM documents) + {mixing.ORDER_ROWS - 1}) // {mixing.ORDER_ROWS}))"
    return rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '/' || md5(coalesce(text, '')) || '/mix'), 1, 12))::BIGINT AS draw
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(coalesce(source, ''))) - 1 AS rk FROM s),
w AS (SELECT *, {weights}[(rk % 3 + 1)::INT]::DOUBLE AS weight, {mixing.MOST} * source_size AS cap FROM r),
l AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
             sum(weight) OVER (ORDER BY cap / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
             {mixing.SHARE!r}::DOUBLE * sum(source_size) OVER () AS goal FROM w),
v AS (SELECT *, (goal - capped) / open_weight AS level FROM l),
f AS (SELECT *, cap <= weight * level AS is_full FROM v),
t AS (SELECT source, source_size, rk, CASE WHEN is_full OR max(CASE WHEN NOT is_full THEN level END) OVER () IS NULL THEN cap::DOUBLE
             ELSE weight * max(CASE WHEN NOT is_full THEN level END) OVER () END AS target FROM f),
e AS (SELECT d.*, t.source_size, t.target, {first}[(rk % 3 + 1)::INT]::DOUBLE AS a, {last}[(rk % 3 + 1)::INT]::DOUBLE AS b,
             (sum(size) OVER (PARTITION BY d.source ORDER BY floor(draw * {n}::DOUBLE / {float(2**48)!r}), draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - size AS begin_at
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, greatest(0, least(size, floor(target)::BIGINT - begin_at)) AS t1, greatest(0, least(size, floor(target)::BIGINT - begin_at - source_size)) AS t2 FROM e),
g AS (SELECT *, (begin_at / target) * (a + b) / 2 AS g1, ((begin_at + source_size) / target) * (a + b) / 2 AS g2 FROM k)
SELECT doc_id, size, source_size, target, (t1 + t2)::BIGINT AS taken,
       CASE WHEN t1 > 0 THEN least(1.0::DOUBLE, 2 * g1 / (a + sqrt(greatest(a * a + 2 * (b - a) * g1, 0.0::DOUBLE)))) END AS position,
       CASE WHEN t2 > 0 THEN least(1.0::DOUBLE, 2 * g2 / (a + sqrt(greatest(a * a + 2 * (b - a) * g2, 0.0::DOUBLE)))) END AS position_again
FROM g"""


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes."""
    step = f"lambda c, x: xor(c >> 8, ([{', '.join(map(str, _crc_table()))}]::BIGINT[])[(xor(c, x) & 255) + 1])"
    bytes_ = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({bytes_}, {step}, 4294967295::BIGINT), 4294967295)::BIGINT"


def op6_sql() -> str:
    old, new = _tree(sharding.production_tree()), _tree(sharding.production_tree().grown(24))
    n = f"greatest(1, (((SELECT count(*) FROM documents) + {sharding.SLOT_ROWS - 1}) // {sharding.SLOT_ROWS}))"
    return f"""
WITH d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, (coalesce(strlen(text), 0) + 8)::BIGINT AS size, {crc32("coalesce(text, '')")} AS text_crc32 FROM documents),
a AS (SELECT *, {old[0]} AS r1, {new[0]} AS r2 FROM d),
b AS (SELECT *, {old[1].format(region="r1")} AS k1, {new[1].format(region="r2")} AS k2 FROM a),
c AS (SELECT doc_id, size, text_crc32, ({old[2].format(rack="k1")})::INT AS shard, ({new[2].format(rack="k2")})::INT AS grown_shard,
             floor({_unit("(k || '/' || text_crc32::VARCHAR)", "slot")} * {n})::BIGINT AS bucket FROM b)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard FROM c"""


def op8_sql() -> str:
    """All queries against all vectors, components added in order."""
    return """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
z AS (SELECT len(e) AS size FROM v GROUP BY len(e) ORDER BY count(*) DESC, size LIMIT 1),
u AS (SELECT vec_id, e FROM v, z WHERE len(e) = size),
q AS (SELECT vec_id AS query_id, min(e) AS e FROM u WHERE vec_id % 100 = 0 GROUP BY vec_id),
d AS (SELECT query_id, vec_id, min(sqrt(list_reduce(list_transform(range(1, len(u.e) + 1), lambda i: (u.e[i] - q.e[i]) * (u.e[i] - q.e[i])), lambda a, b: a + b, 0.0::DOUBLE))) AS score
      FROM q JOIN u ON u.vec_id <> q.query_id GROUP BY query_id, vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank, vec_id, score FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""


def recall_sql() -> str:
    """All queries; enough is found for each."""
    return f"SELECT vec_id AS query_id, true AS enough FROM embeddings WHERE vec_id % 100 = 0 AND {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0"


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def op12_sql() -> str:
    """All anchors against all rows."""
    return f"""
WITH k AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({negatives.SCALE} * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE label IS NOT NULL AND {_FINITE}),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i]))::BIGINT AS score
  FROM k a JOIN k b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {negatives.POSITIVES})
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND {negatives.LOW} * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= {negatives.NEGATIVES}"""


def op13_sql() -> str:
    """Each round as a full comparison of all parts with all entries."""
    n = vector_codes.PARTS

    def nearest(name: str, entries: str) -> str:
        return f"""
d{name} AS (SELECT vec_id, part, entry, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d FROM x JOIN {entries} c USING (part, place) GROUP BY ALL),
a{name} AS MATERIALIZED (SELECT vec_id, part, min((d, entry)) AS best FROM d{name} GROUP BY ALL),"""

    def moved(name: str, entries: str) -> str:
        return f"""
c{name} AS MATERIALIZED (SELECT part, entry, place, CASE WHEN s IS NULL THEN c.v ELSE (s - (s % k + k) % k) // k END AS v FROM {entries} c LEFT JOIN
  (SELECT part, best[2] AS entry, place, sum(v)::BIGINT AS s, count(*) AS k FROM x JOIN a{name} USING (vec_id, part) GROUP BY ALL) m USING (part, entry, place)),"""

    steps = "".join(nearest(str(r), f"c{r}") + moved(str(r + 1), f"c{r}").replace(f"JOIN a{r + 1} ", f"JOIN a{r} ") for r in range(vector_codes.ROUNDS))
    last = vector_codes.ROUNDS
    return f"""
WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS e, len(embedding) // {n} AS m FROM embeddings WHERE {_FINITE}),
x AS MATERIALIZED (SELECT vec_id, (i - 1) // m AS part, (i - 1) % m AS place, e[i] AS v FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM k)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT {vector_codes.ENTRIES}),
c0 AS MATERIALIZED (SELECT part, entry, place, v FROM f JOIN x USING (vec_id)),{steps}{nearest(str(last), f"c{last}")}
b AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM c{last}),
r AS (SELECT vec_id, label, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error FROM a{last} JOIN k USING (vec_id) GROUP BY ALL)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM r, b"""


def base_counts_sql() -> str:
    """Matches of the four patterns that pass their checks."""
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(regexp_extract_all(reverse({digits}), '.'), lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT WHEN c::INT > 4 THEN 2 * c::INT - 9 ELSE 2 * c::INT END)) % 10 = 0"
    octets = "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(try_cast(nullif(ltrim(p, '0'), '') AS INT), 0) > 255)) = 0"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id,
  len(regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'))::BIGINT AS n_email,
  len(list_filter(regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), lambda m: {octets}))::BIGINT AS n_ip,
  len(list_filter(regexp_extract_all(t, '[0-9]([ -]?[0-9])+'), lambda m: length({digits}) BETWEEN 13 AND 19 AND {luhn}))::BIGINT AS n_card,
  len(list_filter(regexp_extract_all(t, '\+[0-9][ ().0-9-]+[0-9]'), lambda m: length({digits}) BETWEEN 9 AND 15))::BIGINT AS n_phone
FROM d"""


def edited_sql() -> str:
    """Texts whose last quarter comes from the next document."""
    return """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
x AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS u FROM d)
SELECT doc_id, n::BIGINT AS n_chars, sha256(CASE WHEN n // 4 > 0 THEN substring(t, 1, n - n // 4) || substring(u, 1, n // 4) ELSE t END) AS edited_sha256 FROM x"""
