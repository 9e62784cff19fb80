"""The registered queries of the numbered operators, over the given tables."""

from __future__ import annotations

from sentinela.llm import (ann, collocations, conversations, ego, jaccard_join, line_dedup, mixing, packing, quality, secrets,
                           sharding, token_files, toxicity)
from sentinela.sources.testdata import table

QUERIES = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op2_sharding(spark, sf_dir):
    """All documents in 24 shards of near equal bytes."""
    return sharding.shard(table(spark, sf_dir, "documents"))


@_query
def op4_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"))


@_query
def op6_token_files(spark, sf_dir):
    """The ids of all documents, written and read back."""
    return token_files.token_files(table(spark, sf_dir, "documents"))


@_query
def op5_quality(spark, sf_dir):
    """A quality score for every document."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op9_toxicity(spark, sf_dir):
    """A toxicity score for every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op7_graph_search(spark, sf_dir):
    """The 10 nearest vectors of every hundredth one."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 100 = 0"), 10)


@_query
def op8_embedding_dedup(spark, sf_dir):
    """Near-duplicate embeddings of one label."""
    return ego.near_duplicates(table(spark, sf_dir, "embeddings"))


@_query
def op10_line_dedup(spark, sf_dir):
    """All documents without lines that occur before, or nearly."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_duplicate_lines(docs)


@_query
def op1_jaccard_join(spark, sf_dir):
    """Groups of documents whose 4-word shingles are near equal."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@_query
def op3_mixing(spark, sf_dir):
    """Every document's place in the mixture of the sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).drop("text")


@_query
def op11_secret_scan(spark, sf_dir):
    """Secrets in all documents."""
    return secrets.digest(table(spark, sf_dir, "documents"))


@_query
def op12_collocations(spark, sf_dir):
    """The 2000 strongest phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@_query
def op13_conversation_repair(spark, sf_dir):
    """Damaged conversations, repaired at the least cost."""
    return conversations.damage_and_repair(table(spark, sf_dir, "conversations"))


def _edit(state: str, cost: str, letter: str, lines: str = "''") -> str:
    """SQL of a state (cost, audit, text) after an edit; null where the state is."""
    return f"CASE WHEN {state} IS NULL THEN NULL ELSE struct_pack(c := {state}.c + {cost}, a := {state}.a || '{letter}', p := {state}.p || {lines}) END"


def _least(*entries: str) -> str:
    return f"list_min([{', '.join(entries)}])"


_I_USER, _I_BOTH = "(chr(10) || 'user:')", "(chr(10) || 'assistant:')"
_KEPT, _AS_USER, _AS_ASSISTANT = (f"(chr(10) || {role} || ':' || text)" for role in ("role", "'user'", "'assistant'"))
_MORE = "CASE fault WHEN 't' THEN 3 ELSE 0 END"


def _kept_or_changed(state: str, initial: str, changed: str) -> str:
    return (f"CASE WHEN fault IN ('b', 'd') THEN NULL WHEN initial = '{initial}' THEN {_edit(state, _MORE, 'K', _KEPT)} "
            f"ELSE {_edit(state, f'({_MORE} + 3)', 'R', changed)} END")


# z, s, u, a: the best (cost, audit, text) of the rows so far in each state of the role pattern; u2 and a2 after insertions.
ORACLE["op13_conversation_repair"] = f"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
      FROM conversations),
k AS (SELECT o.*, xor(list_reduce(list_concat([4294967295], bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM o, crc_table),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM k WHERE kind <> 0),
r AS (SELECT *, left(role, 1) AS initial, row_number() OVER g AS i,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'd'
              WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'k' ELSE 't' END AS fault,
         lag(left(role, 1)) OVER g || left(role, 1) AS pair
      FROM d WINDOW g AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows FROM r GROUP BY 1),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, struct_pack(c := 0, a := '', p := '') AS z, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, p VARCHAR)) AS s,
         CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, p VARCHAR)) AS u, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, p VARCHAR)) AS a FROM n
  UNION ALL
  SELECT conv_id, i, {_edit("z", "4", "D")},
         {_least(_edit("s", "4", "D"), f"CASE WHEN initial = 's' AND fault IN ('k', 't') THEN {_edit('z', _MORE, 'K', _KEPT)} END")},
         {_least(_edit("u2", "4", "D"), *[_kept_or_changed(x, "u", _AS_USER) for x in ("z", "s", "a2")])},
         {_least(_edit("a2", "4", "D"), _kept_or_changed("u2", "a", _AS_ASSISTANT))}
  FROM (SELECT r.conv_id, r.i, role, text, initial, fault, z, s,
               {_least("u", *[_edit(x, "3", "I", _I_USER) for x in ("z", "s", "a")])} AS u2,
               {_least("a", _edit("u", "3", "I", _I_BOTH), *[_edit(x, "6", "II", f"{_I_USER} || {_I_BOTH}") for x in ("z", "s")])} AS a2
        FROM steps JOIN r ON r.conv_id IS NOT DISTINCT FROM steps.conv_id AND r.i = steps.i + 1)),
done AS (SELECT conv_id, {_least("z", "a", _edit("u", "3", "I", _I_BOTH), _edit("s", "6", "II", f"{_I_USER} || {_I_BOTH}"))} AS e
         FROM steps JOIN n USING (conv_id) WHERE i = n_rows)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(e.c, 0) AS BIGINT) AS cost, coalesce(e.a, '') AS audit, sha256(substr(coalesce(e.p, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN n USING (conv_id) LEFT JOIN done USING (conv_id)
"""

ORACLE["op12_collocations"] = """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, range(1, 6) t(k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
sub AS (SELECT lang, array_to_string(string_split(phrase, ' ')[i:j], ' ') AS phrase, max(f) AS held
        FROM f, range(1, 6) x(i), range(1, 6) y(j) WHERE k > 2 AND i <= j AND j <= k AND j - i + 1 < k GROUP BY 1, 2),
c AS (SELECT f.* FROM f LEFT JOIN sub USING (lang, phrase) WHERE k > 1 AND NOT coalesce(100 * held >= 100 * f, false)),
cut AS (SELECT lang, phrase, f AS a, i, array_to_string(string_split(phrase, ' ')[1:i], ' ') AS lp, array_to_string(string_split(phrase, ' ')[i + 1:k], ' ') AS rp
        FROM c, range(1, 5) x(i) WHERE i < k),
s AS (SELECT cut.lang, cut.phrase, a, i, x.f AS l, y.f AS r, n.n, CAST((CAST(a AS HUGEINT) * n.n * 1000) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp JOIN n ON n.lang = cut.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

ORACLE["op8_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
       AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(e, lambda x: abs(x))) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
      ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS node, vec_id AS root FROM v UNION SELECT l.b, reach.root FROM reach JOIN l ON l.a = reach.node),
c AS (SELECT node AS vec_id, min(root) AS component_id FROM reach GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1) USING (vec_id)
"""

ORACLE["op1_jaccard_join"] = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.b, reach.root FROM reach JOIN l ON l.a = reach.node),
c AS (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)
"""
