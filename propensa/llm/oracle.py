"""DuckDB statements for the operators that SQL can express."""

from propensa.llm import merkle

RULES_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT rid, doc_id, t, list_filter(string_split_regex(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l
  FROM docs
), placed AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words
), windows AS (
  SELECT rid, i, struct_pack(a := word, b := lead(word, 1) OVER o, c := lead(word, 2) OVER o,
         d := lead(word, 3) OVER o, e := lead(word, 4) OVER o) AS g, lead(word, 4) OVER o IS NOT NULL AS whole
  FROM placed WINDOW o AS (PARTITION BY rid ORDER BY i)
), repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows WHERE whole) WHERE n > 1
), covered AS (
  SELECT rid, sum(least(5, i - before)) AS n FROM (
    SELECT rid, i, coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), i - 5) AS before FROM repeated) GROUP BY rid
), measured AS (
  SELECT words.doc_id, len(w)::BIGINT AS n_words, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS s,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_bangs,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: list_contains([{stops}], trim(lower(x), '.,;:!?'))))::BIGINT AS n_stop_words
  FROM words LEFT JOIN covered ON words.rid = covered.rid
), judged AS (
  SELECT *, coalesce(s, 0) AS word_chars, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM measured
)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 1.5 * n_words AND word_chars <= 25.0 * n_words
       AND n_symbols <= 0.25 * n_words AND n_bangs <= 0.25 * n_words
       AND n_stop_words + 1 >= 0.01 * n_words AND n_dup_lines <= 0.3 * n_lines AS kept
FROM judged
"""


def _rules() -> str:
    from propensa.llm.quality_rules import STOP_WORDS
    return RULES_SQL.replace("{stops}", ", ".join(f"'{w}'" for w in STOP_WORDS))


def _crc(value: str) -> str:
    """Unsigned CRC-32 (reflected, polynomial EDB88320) of a string's UTF-8
    bytes: eight steps a byte, the first with the byte."""
    octets = f"list_transform(range(0, length(hex(encode({value}))) // 2), " \
             f"lambda i: ('0x' || substr(hex(encode({value})), 2 * i + 1, 2))::BIGINT)"
    steps = f"flatten(list_transform({octets}, lambda b: [b, 0, 0, 0, 0, 0, 0, 0]))"
    return (f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {steps}), "
            "lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))))")


IMPORTANCE_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{merkle.UPPER}', '{merkle.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), goal AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{merkle.UPPER}', '{merkle.LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), words AS (SELECT rid, unnest(w) AS word FROM docs
), hashed AS (
  SELECT word, {_crc('word')} % 10000 AS bucket FROM (SELECT word FROM words UNION SELECT word FROM goal)
), s AS (SELECT bucket, count(*) AS n FROM words JOIN hashed USING (word) GROUP BY 1
), t AS (SELECT bucket, count(*) AS n FROM goal JOIN hashed USING (word) GROUP BY 1
), gain AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM words) + 10000)::DOUBLE)
         / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM goal) + 10000)::DOUBLE)))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket)
), weighed AS (
  SELECT rid, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM words JOIN hashed USING (word) JOIN gain USING (bucket)
  GROUP BY 1
), scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM docs LEFT JOIN weighed USING (rid)
), placed AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (
           PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) END AS place FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank
FROM placed
"""


def _manifest(levels: int = 6, upper: int = 3) -> str:
    """The manifest for up to 8 ** ``levels`` rows of a lang and 8 ** ``upper``
    langs: a step a level, which leaves lone nodes as they are."""
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(
            f"coalesce(strlen({c})::VARCHAR || ':' || {c}, '-')"
            for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"

    def climb(k: int, into: str, run: str) -> str:
        """Nodes n{k} and rows r{k} (tree, pos) one level up."""
        return f"""
, m{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) > 1 AS many FROM n{k}
), b{k} AS (
  SELECT a.tree, a.pos, a.many, coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.d, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM m{k} a JOIN m{k} b ON a.tree = b.tree AND a.pos // 8 = b.pos // 8 GROUP BY 1, 2, 3
), {into} AS (
  SELECT tree, pos // 8 AS pos, CASE WHEN bool_or(many) THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE any_value(d) END AS d
  FROM m{k} GROUP BY 1, 2
), {run} AS (
  SELECT r{k}.* REPLACE (r{k}.pos // 8 AS pos, proof || l || r AS proof,
         CASE WHEN many THEN sha256(l || fold || r) ELSE fold END AS fold)
  FROM r{k} JOIN b{k} USING (tree, pos)
)"""

    steps = "".join(climb(k, f"n{k + 1}" if k + 1 < levels else "tops", f"r{k + 1}" if k + 1 < levels else "ended")
                    for k in range(levels))
    more = "".join(climb(k, f"n{k + 1}", f"r{k + 1}") for k in range(levels, levels + upper))
    tampered = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('text')} AS leaf,
         CASE WHEN {_crc('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(tampered)} END AS other FROM documents
), r0 AS (
  SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, doc_id, leaf,
         '' AS proof, coalesce(other, leaf) AS fold FROM leaves
), n0 AS (SELECT tree, pos, leaf AS d FROM r0){steps}
, subroots AS (SELECT tree AS lang, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, d FROM tops
), n{levels} AS (SELECT tree, pos, d FROM subroots
), r{levels} AS (
  SELECT subroots.tree, subroots.pos, doc_id, leaf, proof, fold, d AS subroot FROM ended JOIN subroots ON ended.tree = lang
){more}
SELECT doc_id, leaf, subroot, (SELECT any_value(d) FROM n{levels + upper}) AS root, sha256(proof) AS proof_sha256,
       fold AS folded_root, fold = (SELECT any_value(d) FROM n{levels + upper}) AS verified
FROM r{levels + upper}
"""


ORACLE = {"op9_quality_rules": _rules(), "op11_importance": IMPORTANCE_SQL, "op13_manifest": _manifest()}
