"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from llm.embedding_dedup import THRESHOLD
from llm.url_filter import RULES

EMBEDDING_DEDUP = f"""
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e,
         embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AS ok
  FROM embeddings),
v AS MATERIALIZED (SELECT r, e FROM given WHERE ok),
linked AS (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.r <> b.r
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= {THRESHOLD}),
reached AS (
  SELECT r, vec_id AS c FROM given
  UNION
  SELECT l.b, x.c FROM reached x JOIN linked l ON l.a = x.r),
least AS (SELECT r, min(c) AS component_id FROM reached GROUP BY r),
counted AS (SELECT a AS r, count(*) AS n FROM linked GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM given JOIN least USING (r) LEFT JOIN counted USING (r)"""


def _host_path(url: str) -> tuple[str, str, str]:
    rest = f"(CASE WHEN contains({url}, '://') THEN substr({url}, instr({url}, '://') + 3) ELSE '' END)"
    raw = f"regexp_extract({rest}, '^[^/?#]*')"
    after = f"substr({rest}, length({raw}) + 1)"
    low = f"translate({raw}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = f"regexp_extract({after}, '^[^?#]*')"
    query = f"regexp_extract(substr({after}, length({path}) + 1), '^(\\?[^#]*)?')"
    return low, path, query


def _attribute(tag: str, name: str) -> str:
    forms = ['"([^"]*)"', "''([^'']*)''", """([^\\s"''>]+)"""]
    found = ", ".join(f"nullif(regexp_extract({tag}, '(?is)\\b{name}\\s*=\\s*{f}', 1), '')" for f in forms)
    return f"trim(coalesce({found}, ''))"


def _rule(host: str, path: str, wanted: str) -> str:
    """The longest fitting rule's text or verdict."""
    rows = ", ".join(f"('{text}', '{text.split('/', 1)[0]}', '/{text.split('/', 1)[1]}', '{verdict}')" for verdict, text in RULES)
    return f"""(SELECT {wanted} FROM (VALUES {rows}) AS rules(txt, dom, pre, verdict)
      WHERE ({host} = dom OR ends_with({host}, '.' || dom)) AND starts_with({path}, pre)
      ORDER BY length(txt) DESC LIMIT 1)"""


def _urls() -> str:
    host, path, query = _host_path("url")
    thost, tpath, tquery = _host_path("target")
    nhost, npath, _ = _host_path("('x://' || n)")
    return f"""
WITH RECURSIVE p AS (
  SELECT page_id, html, coalesce({host}, '') AS host, coalesce({path}, '') AS path,
         {host} || {path} || {query} AS node FROM pages),
tags AS (
  SELECT node, host, path, {_attribute('tag', 'href')} AS t
  FROM (SELECT node, host, path, unnest(regexp_extract_all(html, '(?is)<link\\b[^>]*>')) AS tag FROM p WHERE node <> '')
  WHERE regexp_matches(lower({_attribute('tag', 'rel')}), '(^|\\s)canonical(\\s|$)')
  UNION ALL
  SELECT node, host, path, trim(regexp_extract({_attribute('tag', 'content')}, '(?is)url\\s*=\\s*[''"]?([^''"\\s]+)', 1))
  FROM (SELECT node, host, path, unnest(regexp_extract_all(html, '(?is)<meta\\b[^>]*>')) AS tag FROM p WHERE node <> '')
  WHERE lower({_attribute('tag', 'http-equiv')}) = 'refresh'),
targets AS (
  SELECT node, CASE WHEN t = '' THEN NULL
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN starts_with(t, '//') THEN 'http:' || t
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(t, '#') THEN NULL
    WHEN starts_with(t, '/') THEN 'http://' || host || t
    WHEN starts_with(t, '?') THEN 'http://' || host || path || t
    ELSE 'http://' || host || regexp_replace(path, '[^/]+$', '') || (CASE WHEN contains(path, '/') THEN '' ELSE '/' END) || t
    END AS target FROM tags),
tied AS (
  SELECT node AS a, {thost} || {tpath} || {tquery} AS b FROM targets WHERE target IS NOT NULL),
both_ways AS (SELECT a, b FROM tied WHERE a <> b AND b <> '' UNION SELECT b, a FROM tied WHERE a <> b AND b <> ''),
nodes AS (SELECT a AS n, {_rule(nhost, npath, 'verdict')} AS own FROM (SELECT DISTINCT a, a AS n FROM both_ways)),
tainted AS (
  SELECT n FROM nodes WHERE own = 'block'
  UNION
  SELECT b FROM tainted JOIN both_ways ON a = n)
SELECT page_id, host, path, {_rule('host', 'path', 'txt')} AS rule,
       coalesce({_rule('host', 'path', 'verdict')},
                CASE WHEN node IN (SELECT n FROM tainted) THEN 'block' ELSE 'allow' END) AS verdict
FROM p"""


# crc32 of a decimal number, byte by byte.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)))"""


def _leaf(text: str) -> str:
    parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


def _walk(name: str, start: str, families: str) -> str:
    """Climbs from the nodes of ``start`` (i, g, lvl, pos, proof, node), collecting siblings."""
    k = f"({name}.pos % 3)::INT"
    before = f"array_to_string(f.kids[1:{k}], '')"
    after = f"array_to_string(f.kids[{k} + 2:], '')"
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT i, {name}.g, {name}.lvl + 1, {name}.pos // 3, proof || {before} || {after}, sha256({before} || node || {after})
  FROM {name} JOIN {families} f ON f.g = {name}.g AND f.lvl = {name}.lvl AND f.up = {name}.pos // 3)"""


def _levels(name: str, start: str) -> str:
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT g, lvl + 1, pos // 3, string_agg_digest, (n + 2) // 3
  FROM (SELECT g, lvl, pos // 3 AS up, min(pos) AS pos, max(n) AS n, sha256(string_agg(node, '' ORDER BY pos)) AS string_agg_digest
        FROM {name} WHERE n > 1 GROUP BY g, lvl, up))"""


MANIFEST = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS i, doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND ({_CRC32}) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS other
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, i) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n FROM leaves),
{_levels('nodes', 'SELECT g, 0 AS lvl, pos, leaf AS node, n FROM placed')},
families AS MATERIALIZED (
  SELECT g, lvl, pos // 3 AS up, list(node ORDER BY pos) AS kids FROM nodes WHERE n > 1 GROUP BY g, lvl, up),
subroots AS MATERIALIZED (SELECT g, node FROM nodes WHERE n = 1),
{_levels('high', 'SELECT 0 AS g, 0 AS lvl, g AS pos, node, (SELECT count(*) FROM subroots) AS n FROM subroots')},
clans AS MATERIALIZED (
  SELECT g, lvl, pos // 3 AS up, list(node ORDER BY pos) AS kids FROM high WHERE n > 1 GROUP BY g, lvl, up),
{_walk('low', "SELECT i, g, 0 AS lvl, pos, '' AS proof, other AS node FROM placed", 'families')},
reached AS (SELECT * FROM low QUALIFY row_number() OVER (PARTITION BY i ORDER BY lvl DESC) = 1),
{_walk('up', "SELECT i, 0 AS g, 0 AS lvl, g AS pos, proof, node FROM reached", 'clans')},
ended AS (SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY i ORDER BY lvl DESC) = 1)
SELECT doc_id, leaf, s.node AS subroot, r.node AS root, sha256(proof) AS proof_sha256, e.node AS folded_root,
       e.node = r.node AS verified
FROM placed p JOIN ended e USING (i) JOIN subroots s ON s.g = p.g, (SELECT node FROM high WHERE n = 1) r"""


def llm_oracles() -> dict[str, str]:
    return {"op1_embedding_dedup": EMBEDDING_DEDUP, "op5_urls": _urls(), "op11_manifest": MANIFEST}
