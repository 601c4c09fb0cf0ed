"""SQL for the registered queries that SQL can express."""

from __future__ import annotations

from tidewell.llm import license_scan, mean_order_clusters, secrets, vector_codes, whole_vectors

SQL: dict[str, str] = {}

# The rules of the query, longest first, and its fallback globs as patterns.
SQL["op3_url_filters"] = r"""
    WITH parts AS (
        SELECT page_id,
               translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
        FROM pages),
    ruled AS (
        SELECT *, CASE
            WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
            WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
            WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
            WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
        FROM parts)
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
        WHEN rule IS NOT NULL THEN 'block'
        WHEN regexp_matches(host, 'spam|casino|porn') THEN 'block'
        WHEN regexp_matches(path, '/wp-login[.]php|/cgi-bin/|/calendar/[^/]*/[^/]*/[^/]*/', 's') THEN 'block'
        ELSE 'allow' END AS verdict
    FROM ruled"""


def _license_sql() -> str:
    """Blocks and places by definition: every start, every block, no index."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    places = [f"list_transform(list_filter(range(0, greatest(n_words - {len(t.words) - 1}, 0)), lambda s: "
              f"w[s + 1 : s + {len(t.words)}] = {quoted(t.words)}), lambda s: {{'label': '{t.label}', 'at': s}})" for t in license_scan.PHRASES]
    shares = []
    for t in license_scan.TEMPLATES:
        size, m = len(t.words), len(t.distinct)
        shares.append(f"{{'label': '{t.label}', 'need': {t.need}, 'm': {m}, 'n': coalesce(list_max(list_transform("
                      f"range(0, n_words, {size}), lambda s: len(list_intersect({quoted(t.distinct)}, w[s + 1 : s + {2 * size}])))), 0)}}")
    return f"""
    WITH split AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
        FROM documents),
    counted AS (SELECT *, len(w)::BIGINT AS n_words FROM split),
    found AS (
        SELECT doc_id, n_words, {" || ".join(places)} AS places,
               list_filter([{", ".join(shares)}], lambda f: f.n >= f.need) AS met
        FROM counted),
    labelled AS (
        SELECT *, list_transform(places, lambda p: p.label) AS base, list_transform(met, lambda f: f.label) AS more FROM found)
    SELECT doc_id, n_words, len(places)::BIGINT AS n_base,
           list_min(list_transform(places, lambda p: p.at)) AS first_word, list_max(list_transform(places, lambda p: p.at)) AS last_word,
           coalesce(array_to_string(list_sort(list_distinct(base)), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(base || more)), ','), '') AS labels,
           CASE WHEN len(places) > 0 THEN 1.0::DOUBLE
                ELSE coalesce(list_max(list_transform(met, lambda f: f.n / f.m::DOUBLE)), 0.0::DOUBLE) END AS score
    FROM labelled"""


SQL["op5_license_scan"] = _license_sql()

#: Every pair of vectors, and every pair of texts with a shared shingle, by definition; then all that links reach.
SQL["op1_embedding_near_dedup"] = """
    WITH RECURSIVE usable AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
        WHERE len(embedding) = (SELECT len(embedding) FROM embeddings WHERE len(embedding) > 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
    reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
    counted AS (SELECT x, count(*) AS n FROM links GROUP BY 1),
    least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN least ON least.x = vec_id LEFT JOIN counted ON counted.x = vec_id"""

SQL["op2_ngram_jaccard_join"] = r"""
    WITH RECURSIVE split AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    sets AS (
        SELECT doc_id, list_distinct(CASE
            WHEN len(w) >= 5 THEN list_transform(range(0, len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split),
    tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
        GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
    least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN least ON least.x = doc_id"""


def _secrets_sql() -> str:
    """Matches of each rule over whole texts; a start is the summed length of what lies before it."""
    rules, base = secrets.BASE + secrets.MORE, secrets.BASE
    matched, spans = [], []
    for n, r in enumerate(rules):
        pattern = secrets.without_possessives(r.pattern).replace("'", "''")
        matched.append(f"regexp_extract_all(t, '{pattern}', 0) AS w{n}, regexp_extract_all(t, '{pattern}', {r.group}) AS g{n}, "
                       f"string_split_regex(t, '{pattern}') AS b{n}")
        spans.append(f"list_transform(list_filter(range(1, len(w{n}) + 1), lambda i: length(g{n}[i]) >= {r.least}), lambda i: {{"
                     f"'start': length(array_to_string(b{n}[1 : i], '')) + length(array_to_string(w{n}[1 : i - 1], '')), 'place': {n}, "
                     f"'end': length(array_to_string(b{n}[1 : i], '')) + length(array_to_string(w{n}[1 : i], '')), 'kind': '{r.kind}'}})")
    listed = "array_to_string(list_transform({}, lambda s: concat(s.kind, ':', s.start, ':', s.\"end\")), ',')"
    count = lambda kind: f"len(list_filter(spans, lambda s: s.kind = '{kind}'))::BIGINT AS n_{kind}"
    own = f"list_filter(spans, lambda s: s.place < {len(base)})"
    return f"""
    WITH matched AS (SELECT doc_id, {", ".join(matched)} FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
    found AS (SELECT doc_id, list_sort({" || ".join(spans)}) AS spans FROM matched)
    SELECT doc_id, {", ".join(count(r.kind) for r in base)}, sha256(coalesce({listed.format(own)}, '')) AS base_sha256,
           coalesce({listed.format("spans")}, '') AS spans
    FROM found"""


SQL["op8_secret_scan"] = _secrets_sql()


def _usable(dim: str, most: str) -> str:
    return (f"len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(x) > {most})) = 0")


#: Squared distance of whole numbers held as doubles; exact below 2^53.
_APART = "(list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, c.v) + list_dot_product(c.v, c.v))::BIGINT"


def _rounds(keys: str, size: int, rounds: int) -> str:
    """From `points` (r, keys, v) and `centres0` (keys, c, v): `near{n}` and the next `centres`, `rounds` times, and a last `near`."""
    on = " AND ".join(f"x.{k} = c.{k}" for k in keys.split()) or "true"
    named = "".join(f"{k}, " for k in keys.split())
    full = "".join(f"x.{k}, " for k in keys.split())
    using = "(" + named + "c)"
    steps = []
    for n in range(rounds + 1):
        steps.append(f"near{n} AS MATERIALIZED (SELECT r, {full}any_value(x.v) AS v, min({_APART} * {size} + c.c) AS m "
                     f"FROM points x JOIN centres{n} c ON {on} GROUP BY {full}r)")
        if n < rounds:
            steps.append(f"""
    means{n} AS (SELECT {named}c, list(floor(total / n) ORDER BY place) AS v
        FROM (SELECT {named}c, place, sum(x) AS total, count(*) AS n
              FROM (SELECT {named}m % {size} AS c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM near{n}) GROUP BY {named}c, place)
        GROUP BY {named}c),
    centres{n + 1} AS MATERIALIZED (SELECT {named}c, coalesce(b.v, a.v) AS v FROM centres{n} a LEFT JOIN means{n} b USING {using})""")
    return ",\n    ".join(steps)


def _clusters_sql(n: int = mean_order_clusters.CLUSTERS, rounds: int = mean_order_clusters.ROUNDS, dim: int = mean_order_clusters.DIM) -> str:
    return f"""
    WITH points AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings WHERE {_usable(dim, whole_vectors.largest(dim) // 256)}),
    centres0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM points WHERE vec_id IS NOT NULL
        ORDER BY c LIMIT {n}),
    {_rounds("", n, rounds)}
    SELECT p.vec_id, (m % {n})::INTEGER AS cluster, m // {n} AS distance, (sum(m // {n}) OVER (PARTITION BY m % {n}))::BIGINT AS cluster_inertia,
           (sum(m // {n}) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(c.v, lambda x: x::BIGINT), ',')) AS centroid_sha256
    FROM near{rounds} JOIN points p USING (r) JOIN centres{rounds} c ON c.c = m % {n}"""


def _codes_sql(parts: int = vector_codes.PARTS, n: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    return f"""
    WITH size AS (
        SELECT len(embedding) AS dim, sqrt(4611686018427387904 // len(embedding)) / 512 AS most FROM embeddings
        WHERE len(embedding) > 0 AND len(embedding) % {parts} = 0 GROUP BY 1, 2 ORDER BY count(*) DESC, 1 LIMIT 1),
    kept AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id, label, dim // {parts} AS w, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings, size WHERE {_usable("dim", "most")}),
    points AS MATERIALIZED (SELECT r, p, v[p * w + 1 : p * w + w] AS v FROM kept, range({parts}) t(p)),
    first AS (SELECT r, row_number() OVER (ORDER BY vec_id, v) - 1 AS c FROM kept WHERE vec_id IS NOT NULL ORDER BY c LIMIT {n}),
    centres0 AS MATERIALIZED (SELECT p, c, v FROM points JOIN first USING (r)),
    {_rounds("p", n, rounds)},
    coded AS (
        SELECT r, string_agg(printf('%02x', (m % {n})::INTEGER), '' ORDER BY p) AS code, sum(m // {n})::BIGINT AS error FROM near{rounds} GROUP BY r)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: x::BIGINT), ','), ',' ORDER BY p, c)) FROM centres{rounds}) AS codebooks_sha256
    FROM coded JOIN kept USING (r)"""


SQL["op12_centroid_clustering"] = _clusters_sql()
SQL["op13_vector_codes"] = _codes_sql()
