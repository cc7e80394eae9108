"""SQL for the queries that SQL can express."""

from __future__ import annotations

from shelfmark.llm import linkgraph, secrets


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secrets_sql() -> str:
    """What lies between a rule's matches gives their places, as in the operator."""
    parts = []
    for n, rule in enumerate(secrets.RULES):
        p = _quoted(rule.pattern)
        whole, part, gaps = f"regexp_extract_all(t, {p}, 0)", f"regexp_extract_all(t, {p}, {rule.group})", f"string_split_regex(t, {p})"
        parts.append(f"""
            (SELECT list_transform(list_filter(list_transform(range(len(m)), lambda i: struct_pack(
                a := CAST(list_sum(list_transform(x[1:i + 1], lambda s: length(s))) + coalesce(list_sum(list_transform(m[1:i], lambda s: length(s))), 0) AS BIGINT),
                k := {n}, z := length(m[i + 1]), n := length(g[i + 1]))), lambda s: s.n >= {rule.least}),
              lambda s: struct_pack(a := s.a, k := s.k, z := s.a + s.z))
             FROM (SELECT {whole} AS m, {part} AS g, {gaps} AS x))""")
    names = "[" + ", ".join(_quoted(r.kind) for r in secrets.RULES) + "]"
    base = ", ".join(str(n) for n, r in enumerate(secrets.RULES) if r.base)

    def text(spans: str) -> str:
        return f"coalesce(array_to_string(list_transform({spans}, lambda s: {names}[s.k + 1] || ':' || s.a || ':' || s.z), ','), '')"

    counts = ", ".join(f"CAST(len(list_filter(f, lambda s: s.k = {n})) AS BIGINT) AS n_{r.kind}" for n, r in enumerate(secrets.BASE))
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        s AS (SELECT doc_id, list_sort(flatten([{", ".join(parts)}])) AS f FROM d)
        SELECT doc_id, {counts}, sha256({text(f"list_filter(f, lambda s: s.k IN ({base}))")}) AS base_sha256, {text("f")} AS spans FROM s"""


def linkgraph_sql() -> str:
    """Both rankings as sums of what is passed on, until nearly nothing moves (0.85 ** 200 is 7.7e-15)."""
    rules = sorted(linkgraph.RULES, key=lambda r: -len(r.text))
    fits = " ".join(
        f"WHEN (host = {_quoted(r.host)} OR ends_with(host, {_quoted('.' + r.host)})) AND starts_with(path, {_quoted(r.path)}) THEN {_quoted(r.text)}"
        for r in rules
    )
    ruled = " ".join(f"WHEN {_quoted(r.text)} THEN {_quoted(r.verdict)}" for r in rules)
    big, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
        WITH RECURSIVE a AS (SELECT page_id, html, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
        b AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
        c AS (SELECT page_id, html, translate(raw, '{big}', '{small}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
        d AS (SELECT *, CASE {fits} END AS rule FROM c),
        e AS (SELECT *, CASE rule {ruled} END AS ruled FROM d),
        marked AS (SELECT CASE ruled WHEN 'block' THEN 1 ELSE 0 END AS kind, host, count(*) AS n FROM e WHERE ruled IS NOT NULL AND host <> '' GROUP BY ALL),
        seeds AS MATERIALIZED (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS share FROM marked),
        l AS (SELECT host AS source, translate(unnest(regexp_extract_all(html, {_quoted(linkgraph._LINK)}, 1)), '{big}', '{small}') AS target FROM e WHERE host <> ''),
        links AS (SELECT source, target, count(*) AS n FROM l WHERE target <> '' AND source <> target GROUP BY ALL),
        both_ways AS (SELECT 0 AS kind, source AS host, target AS "to", n FROM links UNION ALL SELECT 1, target, source, n FROM links),
        ways AS MATERIALIZED (SELECT kind, host, "to", n / sum(n) OVER (PARTITION BY kind, host) AS part FROM both_ways),
        passed AS (
            SELECT 0 AS round, kind, host, CAST(share AS DOUBLE) AS score FROM seeds
            UNION ALL
            SELECT round + 1, kind, w."to", sum({linkgraph.DAMPING} * score * part) FROM passed JOIN ways w USING (kind, host)
            WHERE round < 200 AND score > 0 GROUP BY round, kind, w."to"
        ),
        scores AS (SELECT kind, host, sum(score) / sum(sum(score)) OVER (PARTITION BY kind) AS score FROM passed GROUP BY kind, host),
        hosts AS (SELECT host, coalesce(sum(score) FILTER (kind = 1), 0) / sum(score) AS distrust FROM scores GROUP BY host)
        SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN distrust > {linkgraph.LIMIT + linkgraph.CLOSE} THEN 'block' ELSE 'allow' END) AS verdict
        FROM e LEFT JOIN hosts USING (host)"""
