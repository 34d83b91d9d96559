"""DuckDB SQL for the corpus queries that SQL can express over whole tables; the others are tested by brute force.

op1 finds approximately, op3 and op7 merge tokens, op5 and op8 schedule step by step and number rows in hash order,
op6 learns, and op10 estimates: they have none.
"""

from __future__ import annotations

from .embedding_dedup import THRESHOLD
from .licenses import COPYRIGHT_LINE, EQUIVALENT, KNOWN, NOT_WORD
from .suffix_dedup import LENGTH
from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_scan() -> str:
    text = f"regexp_replace(lower(body), {_quoted(COPYRIGHT_LINE)}, '', 'g')"
    text = f"trim(regexp_replace({text}, {_quoted(NOT_WORD)}, ' ', 'g'))"
    for variant, word in EQUIVALENT:
        text = f"regexp_replace({text}, '\\b{variant}\\b', '{word}', 'g')"
    known = ", ".join(f"({_quoted(name)}, {_quoted(body)})" for name, body in KNOWN)
    return f"""
        WITH known AS (SELECT sha256({text}) AS digest, min(license_id) AS license_id
                       FROM (VALUES {known}) AS k(license_id, body) GROUP BY 1),
        scanned AS (SELECT doc_id, sha256({text}) AS digest FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents))
        SELECT doc_id, digest, license_id FROM scanned LEFT JOIN known USING (digest)"""


def suffix_dedup(length: int = LENGTH, block: int = 1024) -> str:
    """Every window of ``length`` bytes by its digest; texts are cut into overlapping blocks only to take windows from."""
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        blocks AS (SELECT r, b, substr(h, 2 * b + 1, 2 * ({block} + {length} - 1)) AS h
                   FROM (SELECT r, h, unnest(range(0, length(h) // 2, {block})) AS b FROM docs)),
        windows AS (SELECT r, b + i AS pos, md5_number(substr(h, 2 * i + 1, 2 * {length})) AS digest
                    FROM (SELECT r, b, h, unnest(range(0, least({block}, length(h) // 2 - {length} + 1))) AS i FROM blocks)),
        repeated AS (SELECT digest FROM windows GROUP BY digest HAVING count(*) > 1),
        hits AS (SELECT r, pos, coalesce(pos > lag(pos) OVER (PARTITION BY r ORDER BY pos) + {length}, true) AS opens
                 FROM windows SEMI JOIN repeated USING (digest)),
        runs AS (SELECT r, pos, sum(opens::int) OVER (PARTITION BY r ORDER BY pos) AS run FROM hits),
        spans AS (SELECT r, min(pos) AS s, max(pos) + {length} AS e FROM runs GROUP BY r, run),
        gaps AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS before FROM spans),
        cut AS (SELECT r, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last,
                       string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS head
                FROM gaps JOIN docs USING (r) GROUP BY r)
        SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
        FROM docs LEFT JOIN cut USING (r)"""


def embedding_near_dedup(threshold: float = THRESHOLD) -> str:
    return f"""
        WITH RECURSIVE given AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
        usable AS MATERIALIZED (SELECT vec_id, x FROM given
            WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        v AS MATERIALIZED (SELECT vec_id, x, sqrt(list_dot_product(x, x)) AS norm FROM usable),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
                  ON a.vec_id <> b.vec_id AND a.norm > 0 AND b.norm > 0 AND len(a.x) = len(b.x)
                  AND list_dot_product(a.x, b.x) / (a.norm * b.norm) >= {threshold}),
        reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT vec_id, b FROM reach JOIN links ON other = a),
        smallest AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
        counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM smallest LEFT JOIN counts USING (vec_id)"""


def _crc32(text: str) -> str:
    """crc32 of an ASCII text: the bits of each byte one after the other (-1 stands for a shift)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [unicode(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    shift = "xor(acc >> 1, CASE WHEN acc & 1 = 1 THEN 3988292384 ELSE 0 END)"
    bits = f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda acc, v: CASE WHEN v < 0 THEN {shift} ELSE xor(acc, v) END), 4294967295)"
    return f"CASE WHEN {text} IS NOT NULL THEN {bits} END"


def merkle_manifest() -> str:
    """Both trees level by level, and every leaf walked up on its own."""
    def digest(text: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, leaves: str) -> str:
        return f"""
        {name} AS (SELECT tree, 0 AS lvl, pos, n, digest FROM {leaves}
            UNION ALL SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
            FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // 3, n),
        {name}_siblings AS (SELECT a.tree, a.lvl, a.pos,
                coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
                coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
            FROM {name} AS a JOIN {name} AS b ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.n > 1 GROUP BY ALL)"""

    def walk(name: str, start: str, over: str) -> str:
        return f"""
        {name}_steps AS ({start}
            UNION ALL SELECT w.row, w.tree, w.lvl + 1, w.pos // 3, sha256(s.l || w.copy || s.r), w.proof || s.l || s.r
            FROM {name}_steps AS w JOIN {over}_siblings AS s ON w.tree = s.tree AND w.lvl = s.lvl AND w.pos = s.pos),
        {name} AS (SELECT row, arg_max(copy, lvl) AS copy, arg_max(proof, lvl) AS proof FROM {name}_steps GROUP BY row)"""

    return f"""
        WITH RECURSIVE given AS (SELECT row_number() OVER () AS row, *, coalesce('=' || source, '-') AS tree, {digest("text")} AS digest,
            {digest("CASE WHEN lost THEN replace(text, chr(10), '') ELSE text END")} AS copy
            FROM (SELECT *, coalesce(({_crc32("doc_id::VARCHAR")}) % 2 = 0, false) AS lost FROM documents)),
        leaves AS (SELECT row, doc_id, tree, digest, copy, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest, row) - 1 AS pos,
            count(*) OVER (PARTITION BY tree) AS n FROM given),
        {tree("lower_", "leaves")},
        tops AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, digest, tree AS source FROM lower_ WHERE n = 1),
        {tree("upper_", "tops")},
        {walk("inside", "SELECT row, tree, 0 AS lvl, pos, copy, '' AS proof FROM leaves", "lower_")},
        {walk("above", "SELECT i.row, '' AS tree, 0 AS lvl, t.pos, i.copy, i.proof FROM inside AS i JOIN leaves AS l USING (row) JOIN tops AS t ON t.source = l.tree", "upper_")}
        SELECT l.doc_id, l.digest AS leaf, t.digest AS subroot, root.digest AS root, sha256(a.proof) AS proof_sha256, a.copy AS folded_root,
               a.copy = root.digest AS verified
        FROM leaves AS l JOIN above AS a USING (row) JOIN tops AS t ON t.source = l.tree CROSS JOIN (SELECT digest FROM upper_ WHERE n = 1) AS root"""


def vector_codes(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """Every round as an assignment of all parts to all entries; components are whole numbers, exact as doubles."""
    def assigned(books: str) -> str:
        far = "list_inner_product(x.part_x, x.part_x) - 2 * list_inner_product(x.part_x, b.entry_x) + list_inner_product(b.entry_x, b.entry_x)"
        return f"""SELECT x.row, x.part, min({{'far': {far}, 'entry': b.entry}}) AS best
            FROM cut AS x JOIN {books} AS b ON x.part = b.part GROUP BY x.row, x.part"""

    steps = "".join(f"""
        near{k} AS MATERIALIZED ({assigned(f"books{k}")}),
        mean{k} AS (SELECT part, entry, list(mean ORDER BY place) AS entry_x
            FROM (SELECT part, entry, place, floor(sum(value) / count(*)) AS mean
                  FROM (SELECT x.part, n.best.entry AS entry, unnest(x.part_x) AS value, unnest(range(len(x.part_x))) AS place
                        FROM cut AS x JOIN near{k} AS n ON x.row = n.row AND x.part = n.part) GROUP BY ALL) GROUP BY ALL),
        books{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.entry_x, b.entry_x) AS entry_x
            FROM books{k} AS b LEFT JOIN mean{k} AS m ON b.part = m.part AND b.entry = m.entry),""" for k in range(rounds))
    return f"""
        WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS row, vec_id, label, x
            FROM (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings)
            WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        size AS (SELECT (max(len(x)) + {parts - 1}) // {parts} AS width FROM kept),
        filled AS (SELECT row, width, list_transform(list_resize(x, width * {parts}, 0::DOUBLE), lambda c: floor({scale} * c)) AS x FROM kept, size),
        cut AS MATERIALIZED (SELECT row, part, x[part * width + 1:(part + 1) * width] AS part_x
            FROM (SELECT *, unnest(range({parts})) AS part FROM filled)),
        books0 AS MATERIALIZED (SELECT part, row AS entry, part_x AS entry_x FROM cut WHERE row < {entries}),{steps}
        last AS MATERIALIZED ({assigned(f"books{rounds}")}),
        coded AS (SELECT row, string_agg(format('{{:02x}}', best.entry), '' ORDER BY part) AS code, sum(best.far)::BIGINT AS error FROM last GROUP BY row),
        digest AS (SELECT sha256(string_agg(array_to_string(list_transform(entry_x, lambda c: c::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books{rounds})
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN kept USING (row), digest"""


def kneser_ney() -> str:
    """The model as tables of pairs, contexts and words. A text's end is the empty word, its beginning a blank."""
    def discounts(name: str, counts: str, column: str) -> str:
        n = ", ".join(f"count(*) FILTER ({column} = {k})::DOUBLE AS n{k}" for k in (1, 2, 3, 4))
        raw = ", ".join(f"{k} - {k + 1} * n1 / (n1 + 2 * n2) * n{k + 1} / n{k} AS d{k}" for k in (1, 2, 3))
        fits = "least(n1, n2, n3, n4) > 0 AND " + " AND ".join(f"d{k} BETWEEN 0 AND {k}" for k in (1, 2, 3))
        chosen = ", ".join(f"CASE WHEN {fits} THEN d{k} ELSE {0.5 * k} END AS {name}{k}" for k in (1, 2, 3))
        return f"{name} AS (SELECT {chosen} FROM (SELECT *, {raw} FROM (SELECT {n} FROM {counts})))"

    def less(count: str, name: str) -> str:
        return f"(CASE WHEN coalesce({count}, 0) = 0 THEN 0 WHEN {count} = 1 THEN 1 - {name}1 WHEN {count} = 2 THEN 2 - {name}2 ELSE {count} - {name}3 END)"

    def counts(column: str) -> str:
        return ", ".join(f"count(*) FILTER ({column} {test}) AS n{k}" for k, test in ((1, "= 1"), (2, "= 2"), (3, ">= 3")))

    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
        WITH split AS (SELECT row_number() OVER () AS row, doc_id, coalesce(({_crc32("doc_id::VARCHAR")}) % 5 = 1, false) AS held_out,
            regexp_extract_all(translate(coalesce(text, ''), {letters}), '[^\x20\x09-\x0D]+') AS words FROM documents),
        tokens AS (SELECT row, held_out, unnest(list_prepend(' ', words)) AS v, unnest(list_append(words, '')) AS w FROM split),
        pairs AS MATERIALIZED (SELECT v, w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY v, w),
        contexts AS MATERIALIZED (SELECT v, sum(c)::BIGINT AS total, {counts("c")} FROM pairs GROUP BY v),
        words AS MATERIALIZED (SELECT w, sum(c)::BIGINT AS c, count(*) AS before FROM pairs GROUP BY w),
        {discounts("d", "pairs", "c")},
        {discounts("e", "words", "before")},
        totals AS (SELECT coalesce(sum(c), 0)::BIGINT AS tokens, count(*) AS words, coalesce(sum(before), 0) AS pairs, {counts("before")} FROM words),
        known AS (SELECT t.row, coalesce(w.c, 0) AS c, tokens, log10((coalesce(w.c, 0) + 0.5) / (tokens + 0.5 * (words + 1))) AS base,
                CASE WHEN pairs > 0 THEN ({less("w.before", "e")} + (e1 * a.n1 + e2 * a.n2 + e3 * a.n3) / (words + 1)) / pairs ELSE 1 END AS lower,
                x.total, {less("p.c", "d")} AS seen, d1 * x.n1 + d2 * x.n2 + d3 * x.n3 AS mass
            FROM tokens AS t LEFT JOIN words AS w ON t.w = w.w LEFT JOIN pairs AS p ON t.v = p.v AND t.w = p.w
                LEFT JOIN contexts AS x ON t.v = x.v, totals AS a, d, e),
        scored AS (SELECT row, count(*) AS n_tokens, count(*) FILTER (c > 0) AS n_known, any_value(tokens) AS train_tokens, sum(base) AS base_score,
            sum(log10(CASE WHEN total IS NULL THEN lower ELSE seen / total + mass / total * lower END)) AS score FROM known GROUP BY row)
        SELECT doc_id, held_out, n_tokens, n_known, train_tokens, round(base_score, 6) AS base_score, round(score, 6) AS score
        FROM scored JOIN split USING (row)"""


SQL = {
    "op11_merkle_manifest": merkle_manifest(),
    "op12_vector_codes": vector_codes(),
    "op13_kneser_ney": kneser_ney(),
    "op2_suffix_dedup": suffix_dedup(),
    "op4_license_scan": license_scan(),
    "op9_embedding_near_dedup": embedding_near_dedup(),
}
