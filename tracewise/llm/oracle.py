"""DuckDB SQL for those queries that SQL can express. Similarities are joined on all shared shingles or all pairs of a
label there, which is exact but fit for small tables only."""

from __future__ import annotations

from tracewise.llm.chat import Template

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_REACH = "reach AS (SELECT a AS node, b AS to_ FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.to_)"


def near_documents(size: int, percent: int) -> str:
    words = _WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")
    return f"""WITH RECURSIVE split AS (SELECT doc_id, {words} AS w FROM documents),
      sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, greatest(len(w) - {size - 1}, 1) + 1), lambda i: array_to_string(w[i:i + {size - 1}], ' '))) END AS s FROM split),
      flat AS (SELECT doc_id, len(s) AS n, md5_number(unnest(s)) AS x FROM sets),
      links AS (SELECT p.doc_id AS a, q.doc_id AS b FROM flat p JOIN flat q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= {percent} * (p.n + q.n - count(*))), {_REACH}
      SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM (SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce((SELECT min(to_) FROM reach WHERE node = doc_id), doc_id)) AS component_id FROM sets)"""


def chat_digests() -> str:
    t = Template()
    esc = lambda c: "replace(" * (len(t.control) + 1) + f"{c}, '\\', '\\\\')" + "".join(f", '{x}', '{x[0]}\\{x[1:]}')" for x in t.control)
    role = f"replace({esc('role')}, chr(10), '<\\n>')"
    fixed = len(t.start) + 1 + len(t.end)
    return f"""WITH rows_ AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
      said AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, sum({fixed} + length({role}) + length({esc('text')}))::BIGINT AS formatted_chars FROM rows_ GROUP BY conv_id)
      SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM said"""


def mix(share: float, epochs: int, seed: int, domains: dict[str, int], langs: dict[str, int]) -> str:
    given = lambda names, c: "CASE " + c + "".join(f" WHEN '{k}' THEN {v}" for k, v in names.items()) + " ELSE 1 END"

    def level(name: str, parent: str, keys: str, weight: str) -> str:
        own, by = keys.split(", ")[-1], ", ".join(keys.split(", ")[:-1]) or "1"
        return f"""{name}_a AS (SELECT n.*, p.budget AS parent_budget, {weight} AS weight, cap::DOUBLE / ({weight})::DOUBLE AS ratio FROM (SELECT {keys}, sum(cap) AS cap FROM leaves GROUP BY ALL) n JOIN {parent} p USING ({by if by != '1' else 'root'})),
      {name}_b AS (SELECT *, cap * sum(weight) OVER (PARTITION BY {by} ORDER BY ratio, {own} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= (parent_budget - coalesce(sum(cap) OVER (PARTITION BY {by} ORDER BY ratio, {own} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight AS is_full FROM {name}_a),
      {name} AS (SELECT {keys}, CASE WHEN is_full THEN cap ELSE greatest((parent_budget - coalesce(sum(cap) FILTER (WHERE is_full) OVER (PARTITION BY {by}), 0)) * weight // sum(weight) FILTER (WHERE NOT is_full) OVER (PARTITION BY {by}), 0) END AS budget FROM {name}_b)"""

    return f"""WITH docs AS (SELECT doc_id, lang, source, len({_WORDS.format('text')}) AS tokens, coalesce(try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT), 0) % 4 AS k FROM documents),
      rows_ AS (SELECT doc_id, CASE WHEN k < 2 THEN 'web' WHEN k = 2 THEN 'news' ELSE 'books' END AS domain, lang, source, tokens FROM docs WHERE tokens > 0),
      leaves AS (SELECT 1 AS root, domain, lang, source, sum(tokens) AS tokens, sum(tokens) * {epochs} AS cap FROM rows_ GROUP BY ALL),
      top AS (SELECT 1 AS root, least(sum(cap), floor(sum(tokens) * {share})::BIGINT) AS budget FROM leaves),
      {level('d', 'top', 'root, domain', given(domains, 'domain'))}, {level('l', 'd', 'root, domain, lang', given(langs, 'lang'))}, {level('s', 'l', 'root, domain, lang, source', '1')},
      plan AS (SELECT domain, lang, source, budget, budget // tokens AS whole, budget % tokens AS rest FROM s JOIN leaves USING (domain, lang, source)),
      part AS (SELECT r.*, p.*, md5('{seed}|' || whole::BIGINT || '|' || doc_id) AS key FROM rows_ r JOIN plan p USING (domain, lang, source)),
      run AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id) - tokens AS before FROM part)
      SELECT doc_id, domain, lang, source, tokens, unnest(range(whole::BIGINT)) AS epoch, budget::BIGINT AS budget FROM part
      UNION ALL SELECT doc_id, domain, lang, source, tokens, whole::BIGINT, budget::BIGINT FROM run WHERE before < rest"""


def near_vectors(least: float) -> str:
    return f"""WITH RECURSIVE good AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
      links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM good p JOIN good q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v) WHERE list_cosine_similarity(p.v, q.v) >= {least}), {_REACH}
      SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM (SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, least(vec_id, coalesce((SELECT min(to_) FROM reach WHERE node = vec_id), vec_id)) AS component_id FROM embeddings)"""


def filter_interactions() -> str:
    """Every document meets every order here."""
    letters = "ABCDE"
    picked = " AND ".join(f"{a}.l <> {b}.l" for i, a in enumerate("vwxyz") for b in "vwxyz"[:i])
    fails = {
        "A": "len(w) < 200", "B": "100 * len(list_distinct(w)) < 50 * len(w)", "C": "100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text)",
        "D": "regexp_matches(text, '[#$%&*|]')", "E": "coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)",
    }
    return f"""WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
      flags AS (SELECT part, doc_id, {', '.join(f"CASE WHEN {c} THEN '{f}' ELSE '' END AS {f}" for f, c in fails.items())} FROM texts),
      said AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
      cells AS (SELECT part, {' || '.join(f'f.{x}' for x in letters)} AS failed, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM flags f LEFT JOIN said USING (doc_id) GROUP BY ALL),
      letters AS (SELECT unnest(split('{'|'.join(letters)}', '|')) AS l), orders AS (SELECT v.l || w.l || x.l || y.l || z.l AS o FROM letters v, letters w, letters x, letters y, letters z WHERE {picked}),
      steps AS (SELECT o, step, o[step] AS f, o[1:step - 1] AS before FROM orders, unnest(range(1, 6)) t(step)),
      met AS (SELECT c.*, s.*, contains(failed, f) AS fails, len(list_filter(string_split(failed, ''), lambda x: x <> '' AND contains(before, x))) > 0 AS gone FROM cells c, steps s),
      told AS (SELECT part, o AS filter_order, f, step::INT AS step, sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN failed = f THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM met GROUP BY ALL)
      SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM told"""


def source_divergence() -> str:
    """All kept terms by all groups, and all pairs of them, are rows here."""
    term = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
    share = lambda n, of, terms: f"1 + (1000000000::HUGEINT * ({n} + 1)) // ({of} + {terms})"
    rank = "row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank"
    return f"""WITH docs AS (SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
      said AS (SELECT id, lang, source, unnest({term}) AS term FROM docs), kept AS (SELECT lang, term FROM said GROUP BY ALL HAVING count(DISTINCT id) >= 3),
      groups AS (SELECT DISTINCT lang, source FROM docs), sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang), counts AS (SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY ALL),
      grid AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v FROM groups g JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN counts c USING (lang, source, term)),
      p AS (SELECT *, {share('n', 'sum(n) OVER (PARTITION BY lang, source)', 'v')} AS p FROM grid), whole AS (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM grid GROUP BY ALL),
      q AS (SELECT lang, term, {share('n', 'sum(n) OVER (PARTITION BY lang)', 'v')} AS q FROM whole),
      sums AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p)::BIGINT AS value FROM p x JOIN p y USING (lang, term) WHERE x.source <> y.source GROUP BY ALL),
      pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
      terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
      SELECT lang, source, 'pair' AS part, item, value, {rank} FROM pairs UNION ALL SELECT lang, source, 'term' AS part, item, value, {rank} FROM terms QUALIFY rank <= 200"""
