"""DuckDB SQL of the Merkle manifest and of conversation repair."""

from __future__ import annotations


def crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit; NULL for NULL."""
    return (
        f"CASE WHEN {text} IS NOT NULL THEN xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
        "lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)), 4294967295) END")


def merkle_sql(levels: int = 7) -> str:
    """Levels as lists per source, for up to 16^``levels`` rows of a source and as many sources."""
    fields = ("doc_id", "source", "lang", "n_chars")
    cell = lambda x: f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"
    head = " || ".join(map(cell, fields))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    changed = f"CASE WHEN ({crc32('doc_id::VARCHAR')}) % 5 = 0 THEN {low} ELSE text END"

    def tree(name: str, first: str) -> str:
        steps = [f"{name}0 AS ({first})"]
        for k in range(levels):
            up = f"list_transform(range(0, len(l{k}), 16), lambda i: sha256(array_to_string(l{k}[i + 1 : i + 16], '')))"
            steps.append(f"{name}{k + 1} AS (SELECT *, CASE WHEN len(l{k}) > 1 THEN {up} ELSE l{k} END AS l{k + 1} FROM {name}{k})")
        return ",\n".join(steps)

    def sides(k: int, place: str) -> tuple[str, str]:
        q, run = f"({place} // {16**k})", f"({place} // {16 ** (k + 1)} * 16)"
        inner = lambda a, b: f"CASE WHEN len(l{k}) > 1 THEN array_to_string(list_slice(l{k}, {a}, {b}), '') ELSE '' END"
        left = f"CASE WHEN {q} > {run} THEN {inner(f'{run} + 1', q)} ELSE '' END"
        return left, inner(f"{q} + 2", f"{run} + 16")

    def climb(name: str, source: str, place: str, node: str) -> str:
        """One level a step, so that an expression is not repeated within itself."""
        steps, last = [], source
        for k in range(levels):
            left, right = sides(k, place)
            steps.append(
                f"{name}{k} AS (SELECT * REPLACE (CASE WHEN len(l{k}) > 1 THEN sha256({left} || {node} || {right}) ELSE {node} END AS {node}, "
                f"proof || {left} || {right} AS proof) FROM {last})")
            last = f"{name}{k}"
        return ",\n".join(steps)

    last = f"l{levels}[1]"
    return f"""
WITH leaves AS (SELECT doc_id, source, sha256({head} || {cell('text')}) AS leaf, sha256({head} || {cell(f'({changed})')}) AS node FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves),
{tree('t', 'SELECT source, list(leaf ORDER BY doc_id NULLS FIRST, leaf) AS l0 FROM leaves GROUP BY source')},
subroots AS (SELECT source, {last} AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS sp FROM t{levels}),
{tree('u', 'SELECT list(subroot ORDER BY sp) AS l0 FROM subroots')},
a AS (SELECT placed.*, '' AS proof, t{levels}.* EXCLUDE (source), {last} AS subroot FROM placed JOIN t{levels} ON placed.source IS NOT DISTINCT FROM t{levels}.source),
{climb('c', 'a', 'p', 'node')},
b AS (SELECT doc_id, leaf, node, proof, c{levels - 1}.subroot, sp, u{levels}.*, u{levels}.{last} AS root FROM c{levels - 1}
  JOIN subroots s ON s.source IS NOT DISTINCT FROM c{levels - 1}.source CROSS JOIN u{levels}),
{climb('d', 'b', 'sp', 'node')}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified FROM d{levels - 1}
"""


def repair_sql() -> str:
    """Edits from the last row to the first, whole audits compared as text; then the audit carried out."""
    least = lambda *ways: f"list_sort([{', '.join(ways)}])[1]"
    way = lambda cost, edits, rest: f"{{'c': {cost} + {rest}.c, 'e': '{edits}' || {rest}.e}}"
    follows = {"s0": "s2", "s1": "s2", "s2": "s3", "s3": "s2"}
    kept = {"s0": {"s": "s1", "u": "s2"}, "s1": {"u": "s2"}, "s2": {"a": "s3"}, "s3": {"u": "s2"}}
    rows, inserts = [], []
    for state, roles in kept.items():
        keep = " ".join(f"WHEN initial = '{r}' THEN {way('late', 'K', to)}" for r, to in roles.items())
        retype = way("2 + late", "R", follows[state])
        never = "{'c': 1000000::BIGINT, 'e': ''}"
        may = f"CASE WHEN gone THEN {never} {keep} ELSE {never} END"
        rows.append(f"{least(way('3', 'D', state), may, f'CASE WHEN gone THEN {never} ELSE {retype} END')} AS {state}")
        one, two = follows[state], follows[follows[state]]
        inserts.append(f"{least(state, way('2', 'I', one), way('4', 'II', two))} AS {state}")
    damage = crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")
    need, follow = "CASE WHEN state = 2 THEN 'assistant' ELSE 'user' END", "CASE WHEN state = 2 THEN 3 ELSE 2 END"
    after = "CASE f.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END"
    return rf"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, ({damage}) % 20 AS h FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM raw JOIN (VALUES (0), (1)) c(k) ON k = 0 OR h = 3 WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(role) || md5(text))) AS i FROM d),
g AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault FROM o),
f AS (SELECT *, fault IN (1, 2) AS gone, CASE WHEN fault = 3 THEN 1 ELSE 0 END::BIGINT AS late,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM g),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
r AS (SELECT conv_id, n + 1 AS i, {{'c': 0::BIGINT, 'e': ''}} AS s0, {{'c': 4::BIGINT, 'e': 'II'}} AS s1, {{'c': 2::BIGINT, 'e': 'I'}} AS s2,
    {{'c': 0::BIGINT, 'e': ''}} AS s3 FROM n
  UNION ALL SELECT conv_id, i, {', '.join(inserts)} FROM (SELECT r.conv_id, f.i, {', '.join(rows)}
    FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i - 1)),
best AS (SELECT n.*, s0.c AS cost, s0.e AS audit FROM r JOIN n ON r.conv_id IS NOT DISTINCT FROM n.conv_id WHERE r.i = 1),
walk AS (SELECT conv_id, audit, 1 AS k, 1::BIGINT AS i, 0 AS state, []::VARCHAR[] AS lines FROM best
  UNION ALL SELECT w.conv_id, audit, k + 1, CASE WHEN e = 'I' THEN w.i ELSE w.i + 1 END,
    CASE e WHEN 'D' THEN state WHEN 'K' THEN {after} ELSE {follow} END,
    CASE e WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, f.role || ':' || f.text) WHEN 'R' THEN list_append(lines, {need} || ':' || f.text)
      ELSE list_append(lines, {need} || ':') END
  FROM (SELECT *, substr(audit, k, 1) AS e FROM walk WHERE k <= length(audit)) w
  LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i),
done AS (SELECT conv_id, sha256(array_to_string(lines, chr(10))) AS hash FROM walk WHERE k = length(audit) + 1),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  coalesce(hash, sha256('')) AS repaired_sha256
FROM ids LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
