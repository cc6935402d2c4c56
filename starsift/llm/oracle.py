"""SQL (DuckDB) for the queries that SQL can state.

Left out: packed rows and token ids (the tokenizer), SimHash (no XXH64 in SQL),
the two fitted models and the pipeline, which contains some of these. Tests compare
them with brute force, the library, an exact round trip or held-out labels.
"""

from __future__ import annotations

from starsift.llm.quality_ledger import POLICIES
from starsift.llm.quality_ledger import RULES as RULES_OF_QUALITY
from starsift.llm.secret_scan import BASE_RULES, RULES
from starsift.llm.url_filter import BLOCK_FROM, DAMPING

CONTAMINATION = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS rn, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
item_at AS (
  SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0
),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM item_at),
sizes AS (SELECT DISTINCT k FROM windows),
doc_at AS (
  SELECT rn, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w JOIN sizes ON len(w) >= k
),
found AS (
  SELECT rn, i, d.k, item_id FROM (SELECT rn, i, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM doc_at) d
  JOIN windows x ON x.k = d.k AND x.s = d.s
),
hits AS (SELECT rn, count(DISTINCT p) AS n FROM (SELECT rn, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT rn, i, k FROM found)) GROUP BY rn),
own AS (SELECT rn, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found WHERE item_id IS NOT NULL GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n, 0) > 0 AS contaminated
FROM w LEFT JOIN hits USING (rn) LEFT JOIN own USING (rn)
"""


def urls(pages: str = "SELECT page_id, url, html FROM pages", steps: int = 100) -> str:
    """Rules, seeds, and the steps of both PageRanks one after the other; what is on its way after them is below 1e-7."""
    walk = ",\n".join(
        f"""m{i + 1} AS MATERIALIZED (SELECT m.kind, e.b AS host, sum(m.mass * e.w) * {DAMPING} AS mass, sum(m.plain * e.w) * {DAMPING} AS plain
  FROM m{i} m JOIN edges e ON e.kind = m.kind AND e.a = m.host GROUP BY m.kind, e.b)"""
        for i in range(steps)
    )
    every = " UNION ALL ".join(f"SELECT * FROM m{i + 1}" for i in range(steps))
    return rf"""
WITH rules(rule, verdict) AS (VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'),
  ('net/es/', 'block'), ('net/fr/', 'block')),
given AS ({pages}),
p AS (SELECT row_number() OVER () AS rn, page_id, html,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM given),
hit AS (SELECT rn, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1)) GROUP BY rn),
judged AS (SELECT p.*, rule, verdict FROM p LEFT JOIN hit USING (rn)),
links AS (SELECT a, b, count(*) AS n FROM (SELECT host AS a, translate(unnest(regexp_extract_all(html,
    '(?i)(?:href|src)\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS b FROM p)
  WHERE a <> '' AND b <> '' AND a <> b GROUP BY a, b),
edges AS MATERIALIZED (SELECT 'trust' AS kind, a, b, n / sum(n) OVER (PARTITION BY a) AS w FROM links
  UNION ALL SELECT 'distrust', b, a, n / sum(n) OVER (PARTITION BY b) FROM links),
seeds AS (SELECT * FROM (
  SELECT 'trust' AS kind, host, avg(CASE WHEN verdict = 'allow' THEN 1.0 ELSE 0.0 END) AS seed FROM judged WHERE host <> '' GROUP BY host
  UNION ALL SELECT 'distrust', host, avg(CASE WHEN verdict = 'block' THEN 1.0 ELSE 0.0 END) FROM judged WHERE host <> '' GROUP BY host) WHERE seed > 0),
ends AS (SELECT DISTINCT kind, host FROM (SELECT kind, a AS host FROM edges UNION ALL SELECT kind, b FROM edges)),
m0 AS MATERIALIZED (SELECT ends.kind, ends.host, {1 - DAMPING} * coalesce(seed, 0) AS mass, {1 - DAMPING} AS plain FROM ends LEFT JOIN seeds USING (kind, host)),
{walk},
got AS (SELECT kind, host, sum(mass) / sum(plain) AS share FROM ({every}) GROUP BY kind, host),
shares AS (SELECT kind, host, greatest(coalesce(seed, 0), coalesce(share, 0)) AS share FROM seeds FULL JOIN got USING (kind, host)),
t AS (SELECT host, coalesce(max(share) FILTER (kind = 'trust'), 0.0) AS trust, coalesce(max(share) FILTER (kind = 'distrust'), 0.0) AS distrust
  FROM shares GROUP BY host)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN distrust >= {BLOCK_FROM} AND distrust > trust THEN 'block' ELSE 'allow' END) AS verdict,
  round(coalesce(trust, 0.0), 4) AS trust, round(coalesce(distrust, 0.0), 4) AS distrust
FROM judged LEFT JOIN t USING (host)
"""


#: The pages with links added: every third one to the host of another page. The host comes from the url as in the rules.
LINKED_PAGES = r"""SELECT a.page_id, a.url, concat(a.html, CASE WHEN a.page_id % 3 = 0 AND b.url LIKE '%://%'
    THEN concat('<a href="//', regexp_extract(b.url, '://([^/?#]*)', 1), '/x">') ELSE '' END) AS html
  FROM pages a LEFT JOIN pages b ON b.page_id = (a.page_id * 7 + 3) % (SELECT count(*) FROM pages)"""


def quality() -> str:
    """Measurements by lists, rules as written in the ledger."""
    bits = {r.name: r.bit for r in RULES_OF_QUALITY}
    fails = {r.name: r.fails for r in RULES_OF_QUALITY}
    total = " + ".join(f"CASE WHEN {sql} THEN {1 << bits[name]} ELSE 0 END" for name, sql in fails.items())
    kept = " AND ".join(f"NOT ({fails[name]})" for name in POLICIES["v1"])
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM documents),
win AS (SELECT rn, i, w[i : i + 4] AS g FROM (SELECT rn, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
rep AS (SELECT rn, count(DISTINCT p) AS n FROM (
  SELECT rn, unnest(range(i, i + 5)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY rn, g) AS c FROM win) WHERE c > 1) GROUP BY rn),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(l) AS n_lines, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
  FROM t LEFT JOIN rep USING (rn))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  {fails["few_words"]} OR {fails["repeated_words"]} AS base_failed, {kept} AS kept, CAST({total} AS BIGINT) AS fail_bits
FROM m
"""


def secrets() -> str:
    """Every pattern over every text; positions from the lengths of what lies between matches."""
    parts = []
    for rank, r in enumerate(RULES):
        rx = r.pattern.replace("'", "''")
        parts.append(
            f"""SELECT rn, {rank} AS rank, '{r.kind}' AS kind, g[i] AS own,
  list_sum(list_transform(p[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) AS s, length(m[i]) AS n
FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT rn, regexp_extract_all(t, '{rx}') AS m,
  regexp_extract_all(t, '{rx}', {r.group}) AS g, string_split_regex(t, '{rx}') AS p FROM d WHERE regexp_matches(t, '{rx}')))
WHERE length(g[i]) >= {r.least}"""
        )
    count = lambda kind: f"CAST(coalesce(count(*) FILTER (kind = '{kind}'), 0) AS BIGINT) AS n_{kind}"
    text = "concat(kind, ':', CAST(CAST(s AS BIGINT) AS VARCHAR), ':', CAST(CAST(s + n AS BIGINT) AS VARCHAR))"
    joined = lambda last: f"coalesce(string_agg({text}, ',' ORDER BY s, rank) FILTER (rank < {last}), '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(parts)})
SELECT doc_id, {", ".join(count(r.kind) for r in BASE_RULES)}, sha256({joined(len(BASE_RULES))}) AS base_sha256, {joined(len(RULES))} AS spans
FROM d LEFT JOIN f USING (rn) GROUP BY d.rn, doc_id
"""


#: CRC-32 of the text of ``id``, from a table made by its rule.
CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY i) AS tbl FROM (SELECT i, list_reduce(list_concat([i], range(8)),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i)))"""


def crc(column: str) -> str:
    return f"""xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST({column} AS VARCHAR), ''),
    lambda ch: CAST(ord(ch) AS BIGINT))), lambda a, x: xor(tbl[CAST(xor(a, x) & 255 AS INT) + 1], a >> 8)))"""


TRIE = rf"""
WITH {CRC_TABLE},
t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS mark FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, mark) AS pos FROM t),
c AS (SELECT c, c - c % 5 AS base, {crc("c")} % 9 AS h FROM (SELECT DISTINCT c FROM t), crc_table),
r0 AS (SELECT c.c, 0 AS part, o.pos, o.role, o.text FROM c JOIN o ON o.c = c.base AND o.pos <= c.h
  UNION ALL SELECT c.c, 1, o.pos, o.role, o.text FROM c JOIN o ON o.c = c.c AND o.pos > c.h),
r AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, concat(strlen(role), ':', strlen(text), ':', role, text) AS said, strlen(text) AS n FROM r0),
p AS (SELECT c, d, n, sha256(string_agg(said, '' ) OVER (PARTITION BY c ORDER BY d)) AS node FROM r
  UNION ALL SELECT c, 0, 0, 'root' FROM c),
up AS (SELECT p.*, q.node AS above, e.last FROM p LEFT JOIN p q ON q.c = p.c AND q.d = p.d - 1 JOIN (SELECT c, max(d) AS last FROM p GROUP BY c) e ON e.c = p.c),
nodes AS (SELECT node, d AS depth, min(c) AS conv_id, min(above) AS above, min(n) AS n, count(*) AS n_convs,
  coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = last), '') AS ends, count(*) FILTER (WHERE d = last) AS n_ends FROM up GROUP BY node, d),
kids AS (SELECT above AS node, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
whole AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (node)),
below AS (SELECT DISTINCT a.node AS top, b.node FROM p a JOIN p b ON b.c = a.c AND b.d >= a.d),
sums AS (SELECT top AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * n) AS saved FROM below JOIN whole USING (node) GROUP BY top)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, w.n_ends, sha256(w.ends) AS ends_sha256
FROM whole w JOIN sums USING (node) LEFT JOIN whole u ON u.node = w.above
"""

LINES = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rn, i, lines[i] AS line, translate(regexp_replace(lines[i], '^[ 	-
]+|[ 	-
]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM (SELECT rn, lines, unnest(range(1, len(lines) + 1)) AS i FROM d)),
often AS (SELECT key FROM (SELECT DISTINCT rn, key FROM l WHERE length(key) >= 1) GROUP BY key HAVING count(*) >= 10),
kept AS (SELECT rn, string_agg(line, chr(10) ORDER BY i) AS kept, count(*) AS n FROM l ANTI JOIN often USING (key) GROUP BY rn)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rn)
"""


def manifest(levels: int = 8) -> str:
    """Level by level, for groups of up to 8 ^ ``levels`` rows: a node is raised while its tree has several."""

    def tree(name: str, leaves: str) -> str:
        """Nodes (grp, place, n, node) of each level, the runs they stand in, and what a node becomes."""
        out = [f"{name}0 AS ({leaves})"]
        for i in range(levels):
            out.append(f"""{name}{i + 1} AS (SELECT grp, CAST(floor(place / 8) AS BIGINT) AS place, CAST(ceil(any_value(n) / 8.0) AS BIGINT) AS n,
  CASE WHEN any_value(n) > 1 THEN sha256(string_agg(node, '' ORDER BY place)) ELSE any_value(node) END AS node FROM {name}{i} GROUP BY grp, floor(place / 8))""")
        return ",\n".join(out)

    def siblings(name: str, i: int, place: str, grp: str) -> tuple[str, str]:
        """Runs of a level joined by a leaf's place, as a list of nodes."""
        alias = f"{name}r{i}"
        join = f"""LEFT JOIN (SELECT grp, CAST(floor(place / 8) AS BIGINT) AS run, any_value(n) AS n, list(node ORDER BY place) AS nodes FROM {name}{i} GROUP BY grp, floor(place / 8)) {alias}
  ON {alias}.grp IS NOT DISTINCT FROM {grp} AND {alias}.run = CAST(floor({place} / {8 ** (i + 1)}) AS BIGINT)"""
        at = f"CAST(floor({place} / {8 ** i}) AS BIGINT) % 8"
        left = f"array_to_string({alias}.nodes[1 : {at}], '')"
        right = f"array_to_string({alias}.nodes[{at} + 2 : 8], '')"
        return join, f"CASE WHEN {alias}.n > 1 THEN struct_pack(l := {left}, r := {right}) END"

    def field(c: str, text: str) -> str:
        return f"coalesce(concat(strlen({text}), ':', {text}), '-')"

    def leaf(text: str) -> str:
        cast = {"doc_id": "CAST(doc_id AS VARCHAR)", "source": "source", "lang": "lang", "n_chars": "CAST(n_chars AS VARCHAR)", "text": text}
        return f"sha256(concat({', '.join(field(c, t) for c, t in cast.items())}))"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    joins, steps = [], []
    for name, place, grp in (("a", "x.place", "x.grp"), ("b", "y.place", "0")):
        for i in range(levels):
            join, step = siblings(name, i, place, grp)
            joins.append(join)
            steps.append(step)
    return f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, lang, {leaf("text")} AS leaf, CASE WHEN {crc("doc_id")} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS changed FROM documents, crc_table),
x AS (SELECT *, lang AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM d),
{tree("a", "SELECT grp, place, n, leaf AS node FROM x")},
y AS (SELECT grp, node AS subroot, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM a{levels}),
{tree("b", "SELECT 0 AS grp, place, n, subroot AS node FROM y")},
proofs AS (SELECT x.doc_id, x.leaf, x.changed, y.subroot, list_filter([{", ".join(steps)}], lambda s: s IS NOT NULL) AS steps
  FROM x JOIN y ON y.grp IS NOT DISTINCT FROM x.grp
  {" ".join(joins)}),
folded AS (SELECT p.*, (SELECT node FROM b{levels}) AS root, list_reduce(list_concat([struct_pack(l := changed, r := '')], steps),
    lambda node, s: struct_pack(l := sha256(concat(s.l, node.l, s.r)), r := '')).l AS folded_root FROM proofs p)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: concat(s.l, s.r)), '')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM folded
"""


SQL: dict[str, str] = {
    "op1_decontaminate": CONTAMINATION,
    "op4_url_filter": urls(),
    "linked_url_filter": urls(LINKED_PAGES),
    "op9_quality_ledger": quality(),
    "op10_secret_scan": secrets(),
    "op11_prefix_trie": TRIE,
    "op12_line_dedup": LINES,
    "op13_merkle_manifest": manifest(),
}
