"""The same results in DuckDB SQL, built from named common table expressions."""

from __future__ import annotations

from precis.functions.chars import STOPWORDS
from precis.settings import SUMMARY, TEXT
from registry.queries import ALIGN_ROUNDS, BEAM, BOUNDED_WORDS, LEAST_P, ROUNDS, STEPS, SUMMARY_WORDS, TEXT_WORDS


# Whitespace as Python splits by, as ranges, and its word characters.
_WS_RANGES = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same characters one by one, and cells that count as missing: written out here
# again, so that a wrong entry in the code shows.
WS_CHARS = "".join(map(chr, (
    *range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)))
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
WS, NWS, W = f"[{_WS_RANGES}]", f"[^{_WS_RANGES}]", r"[\p{L}\p{N}_]"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- expressions ------------------------------------------------------------


def gone(c: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({c}, {lit(pattern)}, {lit(by)}, 'g')"


def trim(c: str) -> str:
    return f"trim({c}, {lit(WS_CHARS)})"


def clean(c: str, lower: bool = True, emails_first: bool = False, bare: bool = False) -> str:
    text = f"coalesce({c}, '')"
    if lower:
        text = f"lower({text})"
    text = gone(text, f"http{NWS}+|www{NWS}+")
    steps = [f"@{W}+|#{W}+", f"{NWS}+@{NWS}+"]
    for pattern in reversed(steps) if emails_first else steps:
        text = gone(text, pattern)
    text = gone(text, f"{WS}+", " ")
    if bare:
        text = f"strip_accents({text})"
    return f"trim({text})"


def light(c: str) -> str:
    text = gone(f"lower(coalesce({c}, ''))", f"http{NWS}+|www{NWS}+")
    return trim(gone(text, f"@{W}+|#{W}+"))


def words(c: str) -> str:
    return f"list_filter(string_split_regex(coalesce({c}, ''), {lit(WS + '+')}), lambda w: w <> '')"


def pieces(c: str, pattern: str) -> str:
    parts = f"string_split_regex({c}, {lit(pattern)})"
    return f"list_filter(list_transform({parts}, lambda s: {trim('s')}), lambda s: s <> '')"


def is_content(w: str) -> str:
    return f"(length({w}) > 2 AND {w} NOT IN ({', '.join(map(lit, STOPWORDS))}))"


def r6(c: str) -> str:
    return f"round({c}, 6)"


def glue(c: str, by: str = " ") -> str:
    return f"array_to_string({c}, {lit(by)})"


def ratio(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} ELSE 0.0::DOUBLE END"


def digest(seed: int = 42) -> str:
    return f"md5(concat(doc_id, '-{seed}'))"


def adaptive_k(n: str) -> str:
    return (
        f"CAST(CASE WHEN {n} <= 5 THEN greatest(2, {n} - 1) "
        f"WHEN {n} <= 10 THEN greatest(3, floor({n} * CAST(0.4 AS DOUBLE))) "
        f"ELSE greatest(4, floor({n} * CAST(0.35 AS DOUBLE))) END AS INT)"
    )


def joined_fragments(kept: str, n: str) -> str:
    body = glue(kept, ". ")
    return (
        f"CASE WHEN {n} = 0 THEN '' WHEN {n} <= 2 OR NOT ends_with({body}, '.') "
        f"THEN {body} || '.' ELSE {body} END"
    )


# --- common table expressions: name -> (SQL, names it needs) ----------------

CTES: dict[str, str] = {}
NEEDS: dict[str, list[str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name], NEEDS[name] = sql, list(needs)


def with_ctes(select: str, *needs: str) -> str:
    """A full statement with everything it needs, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in NEEDS[name]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return select
    parts = ",\n".join(f"{n} AS ({CTES[n]})" for n in order)
    return f"WITH RECURSIVE {parts}\n{select}"


cte("docs", "SELECT doc_id, text FROM documents")
cte("turns", f"""
    SELECT u.conv_id * 1048576 + u.turn AS doc_id, u.text AS {TEXT}, a.text AS {SUMMARY}
    FROM conversations u LEFT JOIN conversations a
      ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
    WHERE u.role = 'user'""")
cte("pairs", f"SELECT * FROM turns WHERE {SUMMARY} IS NOT NULL", "turns")
cte("clean_docs", f"SELECT doc_id, {clean('text')} AS clean FROM docs", "docs")
cte("clean_pairs",
    f"SELECT doc_id, {clean(TEXT)} AS {TEXT}, {clean(SUMMARY)} AS {SUMMARY} FROM pairs", "pairs")
cte("clean_items", f"SELECT item_id AS doc_id, {clean('text')} AS clean FROM benchmark")


def split_cte(name: str, source: str, fraction: float) -> None:
    cte(name, f"""
        SELECT *, row_number() OVER (ORDER BY {digest()}) <=
            round_even({fraction} * count(*) OVER (), 0) AS chosen FROM {source}""", source)


split_cte("split_docs", "docs", 0.8)
split_cte("split_pairs", "pairs", 0.8)
split_cte("split_back", "pairs", 0.2)
HASH_TRAIN = f"substr({digest()}, 1, 8) < '{int(0.8 * 2**32):08x}'"


def token_ctes(prefix: str, source: str, column: str) -> None:
    """``<prefix>_words`` (doc_id, pos, word), ``<prefix>_freq``, ``<prefix>_ids``."""
    cte(f"{prefix}_lists", f"SELECT doc_id, {words(column)} AS words FROM {source}", source)
    cte(f"{prefix}_words", f"""
        SELECT doc_id, CAST(unnest(range(len(words))) AS INT) AS pos, unnest(words) AS word
        FROM {prefix}_lists""", f"{prefix}_lists")
    cte(f"{prefix}_seen", f"""
        SELECT doc_id, word, count(*) AS c,
            row_number() OVER (PARTITION BY doc_id ORDER BY min(pos)) - 1 AS place
        FROM {prefix}_words GROUP BY doc_id, word""", f"{prefix}_words")
    cte(f"{prefix}_freq", f"""
        SELECT word, CAST(sum(c) AS BIGINT) AS freq, min(doc_id) AS first_doc,
            CAST(arg_min(place, doc_id) AS INT) AS first_rank
        FROM {prefix}_seen GROUP BY word""", f"{prefix}_seen")


def vocab_cte(name: str, freq: str, capacity: int) -> None:
    cte(name, f"""
        SELECT * FROM (VALUES ('<PAD>', 0, 0::BIGINT), ('<UNK>', 1, 0), ('<START>', 2, 0),
            ('<END>', 3, 0)) AS s(token, id, freq)
        UNION ALL
        SELECT word, CAST(rank + 3 AS INT), freq FROM (
            SELECT word, freq, row_number() OVER (ORDER BY freq DESC, first_doc, first_rank) AS rank
            FROM {freq} WHERE word NOT IN ('<PAD>', '<UNK>', '<START>', '<END>'))
        WHERE rank <= {capacity - 4}""", freq)


def ids_cte(name: str, prefix: str, vocab: str) -> None:
    """Encoded texts, ``[]`` for those without words."""
    cte(name, f"""
        SELECT l.doc_id, coalesce(ids, []) AS ids FROM {prefix}_lists l LEFT JOIN (
            SELECT doc_id, list(coalesce(id, 1) ORDER BY pos) AS ids
            FROM {prefix}_words LEFT JOIN {vocab} ON token = word GROUP BY doc_id
        ) e ON e.doc_id = l.doc_id""", f"{prefix}_words", vocab)


token_ctes("doc", "clean_docs", "clean")
token_ctes("item", "clean_items", "clean")
token_ctes("sum", "clean_pairs", SUMMARY)
token_ctes("txt", "clean_pairs", TEXT)
vocab_cte("doc_vocab", "doc_freq", TEXT_WORDS)
vocab_cte("sum_vocab", "sum_freq", SUMMARY_WORDS)
ids_cte("doc_ids", "doc", "doc_vocab")
ids_cte("sum_ids", "sum", "sum_vocab")
ids_cte("txt_sum_ids", "txt", "sum_vocab")
cte("marked", "SELECT doc_id, [2] || ids || [3] AS ids FROM sum_ids", "sum_ids")


def padded(ids: str, length: int) -> str:
    return f"list_resize({ids}[1:{length}], {length}, 0)"


# Sentences of cleaned texts, and corpus TF-IDF.
SENTENCES = "[.!?]+" + WS + "+"


def sentence_ctes(name: str, source: str, column: str, pattern: str) -> None:
    cte(f"{name}_lists", f"SELECT doc_id, {pieces(column, pattern)} AS parts FROM {source}", source)
    cte(name, f"""
        SELECT doc_id, CAST(unnest(range(len(parts))) AS INT) AS idx, unnest(parts) AS sentence
        FROM {name}_lists""", f"{name}_lists")


sentence_ctes("sentences", "clean_docs", "clean", SENTENCES)
sentence_ctes("raw_sentences", "docs", "text", SENTENCES)
cte("sentence_words", f"""
    SELECT doc_id, idx, len(ws) AS n, unnest(ws) AS word
    FROM (SELECT doc_id, idx, {words('sentence')} AS ws FROM sentences)""", "sentences")
cte("df", "SELECT word, count(*) AS df FROM doc_seen GROUP BY word", "doc_seen")
cte("idf", """
    SELECT word, df, ln((SELECT count(*) FROM docs)::DOUBLE / (1 + df)) AS idf FROM df""",
    "docs", "df")
cte("scores", """
    SELECT s.doc_id, s.idx, coalesce(score, 0.0::DOUBLE) AS score, s.sentence FROM sentences s LEFT JOIN (
        SELECT doc_id, idx, sum(coalesce(idf, 0.0::DOUBLE)) / max(n) AS score
        FROM sentence_words LEFT JOIN idf USING (word) GROUP BY doc_id, idx
    ) t ON t.doc_id = s.doc_id AND t.idx = s.idx""", "sentences", "sentence_words", "idf")

BEST_FIRST = "PARTITION BY doc_id ORDER BY round(score, 10) DESC, idx DESC"


# Fragments and their scores, for documents (d) and for the texts of pairs (p).
def fragment_ctes(prefix: str, source: str, column: str) -> None:
    p = prefix
    cte(f"{p}_light", f"SELECT doc_id, {light(column)} AS t FROM {source}", source)
    cte(f"{p}_both", f"""
        SELECT doc_id, {pieces('t', chr(10))} AS lines,
            list_filter({pieces('t', '[.!?]+')}, lambda s: len({words('s')}) > 3) AS sents
        FROM {p}_light""", f"{p}_light")
    cte(f"{p}_lists", f"""
        SELECT doc_id, CASE WHEN len(lines) <= 3 AND len(sents) > len(lines)
            THEN sents ELSE lines END AS parts FROM {p}_both""", f"{p}_both")
    cte(f"{p}_frags", f"""
        SELECT doc_id, len(parts) AS n_fragments, CAST(unnest(range(len(parts))) AS INT) AS idx,
            unnest(parts) AS fragment FROM {p}_lists""", f"{p}_lists")
    cte(f"{p}_fw", f"""
        SELECT doc_id, n_fragments, idx, len(ws) AS n,
            CAST(unnest(range(len(ws))) AS INT) AS pos, unnest(ws) AS word
        FROM (SELECT *, {words('fragment')} AS ws FROM {p}_frags)""", f"{p}_frags")
    cte(f"{p}_idf", f"""
        SELECT doc_id, word, df, ln(n_fragments::DOUBLE / (1 + df)) AS idf FROM (
            SELECT doc_id, word, any_value(n_fragments) AS n_fragments, count(DISTINCT idx) AS df
            FROM {p}_fw WHERE length(word) > 2 GROUP BY doc_id, word)""", f"{p}_fw")
    cte(f"{p}_cw", f"""
        SELECT *, row_number() OVER (PARTITION BY doc_id, idx ORDER BY pos) - 1 AS cpos
        FROM {p}_fw WHERE {is_content('word')}""", f"{p}_fw")
    cte(f"{p}_cfreq", f"""
        SELECT doc_id, word, count(*) AS freq, min(idx) AS first_idx,
            CAST(min(CAST(idx AS BIGINT) * 4294967296 + cpos) % 4294967296 AS INT) AS first_pos
        FROM {p}_cw GROUP BY doc_id, word""", f"{p}_cw")
    cte(f"{p}_imp", f"""
        SELECT doc_id, word, freq, CAST(rank AS INT) AS rank FROM (
            SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_distinct, row_number() OVER (
                PARTITION BY doc_id ORDER BY freq DESC, first_idx, first_pos) AS rank FROM {p}_cfreq)
        WHERE rank <= greatest(5, n_distinct // 5)""", f"{p}_cfreq")
    cte(f"{p}_terms", f"""
        SELECT doc_id, idx, word, count(*) AS c FROM {p}_cw GROUP BY doc_id, idx, word""", f"{p}_cw")
    cte(f"{p}_sums", f"""
        SELECT t.doc_id, t.idx, sum(c) AS m, sum(c * idf) AS weight,
            count(*) FILTER (WHERE i.word IS NOT NULL) AS u
        FROM {p}_terms t JOIN {p}_idf USING (doc_id, word)
            LEFT JOIN {p}_imp i ON i.doc_id = t.doc_id AND i.word = t.word
        GROUP BY t.doc_id, t.idx""", f"{p}_terms", f"{p}_idf", f"{p}_imp")
    cte(f"{p}_scores", f"""
        SELECT f.doc_id, f.n_fragments, f.idx, f.fragment, coalesce(
            (CAST(0.7 AS DOUBLE) * (weight / m / m) + CAST(0.3 AS DOUBLE) * (u::DOUBLE / m)) *
            greatest(0.5::DOUBLE, 1.0::DOUBLE - abs(len({words('fragment')}) - 10)::DOUBLE / 20), 0.0::DOUBLE) AS score
        FROM {p}_frags f LEFT JOIN {p}_sums s ON s.doc_id = f.doc_id AND s.idx = f.idx""",
        f"{p}_frags", f"{p}_sums")
    cte(f"{p}_kept", f"""
        SELECT doc_id, list(idx ORDER BY idx) AS kept, list(fragment ORDER BY idx) AS chosen FROM (
            SELECT *, row_number() OVER ({BEST_FIRST}) AS rank FROM {p}_scores)
        WHERE rank <= {adaptive_k('n_fragments')} GROUP BY doc_id""", f"{p}_scores")
    cte(f"{p}_summary", f"""
        SELECT l.doc_id, CAST(len(parts) AS INT) AS n_fragments,
            CASE WHEN len(parts) <= 2 THEN parts ELSE chosen END AS chosen,
            {joined_fragments('CASE WHEN len(parts) <= 2 THEN parts ELSE chosen END', 'len(parts)')} AS summary
        FROM {p}_lists l LEFT JOIN {p}_kept k ON k.doc_id = l.doc_id""", f"{p}_lists", f"{p}_kept")


fragment_ctes("d", "docs", "text")
fragment_ctes("p", "pairs", TEXT)

# ROUGE-1 of pairs and of summaries.
for _name, _source, _ref, _gen in (
    ("pair_sets", "pairs", SUMMARY, TEXT),
    ("triple_sets", "triples", SUMMARY, "generated"),
):
    cte(_name, f"""
        SELECT *, list_distinct({words(f'lower({_ref})')}) AS ref,
            list_distinct({words(f'lower({_gen})')}) AS gen FROM {_source}""", _source)
    cte(_name.replace("sets", "pr"), f"""
        SELECT *, {ratio('len(list_intersect(ref, gen))', 'len(gen)')} AS p,
            {ratio('len(list_intersect(ref, gen))', 'len(ref)')} AS r FROM {_name}""", _name)
F1 = "CASE WHEN p + r > 0 THEN 2 * (p * r) / (p + r) ELSE 0.0::DOUBLE END"
cte("triples", f"""
    SELECT pairs.doc_id, {TEXT}, {SUMMARY}, summary AS generated
    FROM pairs JOIN p_summary USING (doc_id)""", "pairs", "p_summary")

# Next-token table and decoding.
cte("steps", """
    SELECT doc_id, unnest(ids[1:len(ids) - 1]) AS prev, unnest(ids[2:]) AS next FROM marked""", "marked")
# The same with padding up to the usual length.
cte("padded_steps", """
    SELECT doc_id, unnest(ids[1:len(ids) - 1]) AS prev, unnest(ids[2:]) AS next
    FROM (SELECT doc_id, list_resize(ids, greatest(len(ids), 100), 0) AS ids FROM marked)""", "marked")
cte("probs", """
    SELECT prev, next, c::DOUBLE / sum(c) OVER (PARTITION BY prev) AS p FROM (
        SELECT prev, next, count(*) AS c FROM steps WHERE next <> 0 GROUP BY prev, next)""", "steps")
cte("best", """
    SELECT prev, next, p FROM probs
    QUALIFY row_number() OVER (PARTITION BY prev ORDER BY p DESC, next) = 1""", "probs")
cte("top", f"""
    SELECT prev, next, p FROM probs
    QUALIFY row_number() OVER (PARTITION BY prev ORDER BY p DESC, next DESC) <= {BEAM}""", "probs")
# Successors in the text itself, mixed with those of the corpus; owner -1 is the corpus alone.
cte("own_steps", """
    SELECT doc_id, prev, next, count(*) AS c FROM (
        SELECT doc_id, unnest(ids[1:len(ids) - 1]) AS prev, unnest(ids[2:]) AS next
        FROM (SELECT doc_id, [2] || ids || [3] AS ids FROM txt_sum_ids))
    WHERE next <> 1 GROUP BY doc_id, prev, next""", "txt_sum_ids")
cte("own", """
    SELECT o.doc_id AS owner, o.prev, o.next,
        0.5::DOUBLE * coalesce(p, 0.0::DOUBLE) + 0.5::DOUBLE * (c::DOUBLE / sum(c) OVER (PARTITION BY o.doc_id, o.prev)) AS p
    FROM own_steps o LEFT JOIN probs b ON b.prev = o.prev AND b.next = o.next""", "own_steps", "probs")
cte("seen", "SELECT DISTINCT owner, prev FROM own", "own")
for _kind, _corpus, _order, _k in (("best", "best", "next", 1), ("top", "top", "next DESC", BEAM)):
    cte(f"{_kind}_choices", f"""
        SELECT owner, prev, next, p FROM (
            SELECT * FROM own UNION ALL
            SELECT s.owner, s.prev, t.next, 0.5::DOUBLE * t.p FROM seen s JOIN {_corpus} t ON t.prev = s.prev
            WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.owner = s.owner AND o.prev = s.prev AND o.next = t.next)
            UNION ALL SELECT -1, prev, next, 0.5::DOUBLE * p FROM {_corpus})
        QUALIFY row_number() OVER (PARTITION BY owner, prev ORDER BY p DESC, {_order}) <= {_k}""",
        "own", "seen", _corpus)
cte("greedy", f"""
    SELECT doc_id, [2] AS seq, 0.0::DOUBLE AS score, false AS done, 0 AS step FROM txt_sum_ids
    UNION ALL
    SELECT doc_id, CASE WHEN next IS NULL OR next = 3 THEN seq ELSE list_append(seq, next) END,
        score + CASE WHEN next IS NULL THEN 0.0::DOUBLE ELSE ln(p + 1e-10::DOUBLE) END,
        next IS NULL OR next = 3, step + 1
    FROM greedy g LEFT JOIN seen s ON s.owner = g.doc_id AND s.prev = g.seq[-1]
        LEFT JOIN best_choices c ON c.owner = coalesce(s.owner, -1) AND c.prev = g.seq[-1]
    WHERE NOT done AND step < {STEPS}""", "txt_sum_ids", "seen", "best_choices")
cte("greedy_end", "SELECT doc_id, arg_max(seq, step) AS seq, arg_max(score, step) AS score FROM greedy GROUP BY doc_id",
    "greedy")
cte("beams", f"""
    SELECT doc_id, 1::BIGINT AS hyp_id, [2] AS seq, 0.0::DOUBLE AS score, false AS done, 0 AS step FROM txt_sum_ids
    UNION ALL
    SELECT doc_id, rank, seq, score, done, step FROM (
        SELECT *, row_number() OVER (
            PARTITION BY doc_id ORDER BY round(score, 10) DESC, hyp_id, next) AS rank
        FROM (
            SELECT b.doc_id, hyp_id, next,
                CASE WHEN next IS NULL THEN seq ELSE list_append(seq, next) END AS seq,
                score + CASE WHEN next IS NULL THEN 0.0::DOUBLE ELSE ln(p + 1e-10::DOUBLE) END AS score,
                done OR next IS NULL OR next = 3 AS done, step + 1 AS step
            FROM beams b LEFT JOIN seen s ON s.owner = b.doc_id AND s.prev = b.seq[-1]
                LEFT JOIN top_choices c ON NOT done AND c.owner = coalesce(s.owner, -1) AND c.prev = b.seq[-1]
            WHERE step < {STEPS}))
    WHERE rank <= {BEAM}""", "txt_sum_ids", "seen", "top_choices")
cte("beam_end", f"SELECT doc_id, seq, score FROM beams WHERE step = {STEPS} AND hyp_id = 1", "beams")


def decoded(source: str, specials: bool = False) -> str:
    """Ids of ``seq`` back to a text."""
    kept = "" if specials else "WHERE i NOT IN (0, 2, 3)"
    return f"""
        SELECT s.doc_id, coalesce(t, '') AS summary FROM {source} s LEFT JOIN (
            SELECT doc_id, string_agg(coalesce(token, '<UNK>'), ' ' ORDER BY pos) AS t FROM (
                SELECT doc_id, unnest(range(len(seq))) AS pos, unnest(seq) AS i FROM {source})
            LEFT JOIN sum_vocab ON id = i {kept} GROUP BY doc_id
        ) d ON d.doc_id = s.doc_id"""


# --- one statement per query ------------------------------------------------

SQL: dict[str, str] = {}


def oracle(name: str, select: str, *needs: str) -> None:
    SQL[name] = with_ctes(select, *needs)


_na = ", ".join(map(lit, NA_TOKENS))
oracle("read_pairs", f"""
    SELECT CASE WHEN {TEXT} IN ({_na}) THEN NULL ELSE {TEXT} END AS {TEXT},
        CASE WHEN {SUMMARY} IN ({_na}) THEN NULL ELSE {SUMMARY} END AS {SUMMARY} FROM pairs""", "pairs")
oracle("append_pairs", f"""
    SELECT * REPLACE (CASE WHEN {HASH_TRAIN} THEN '0-' ELSE '1-' END || doc_id AS doc_id),
        CASE WHEN {HASH_TRAIN} THEN 'train' ELSE 'validation' END AS source FROM pairs""", "pairs")
oracle("append_stream", "SELECT *, 'user' AS source FROM pairs", "pairs")
oracle("word_freq_stream", "SELECT * FROM doc_freq", "doc_freq")
oracle("write_split", """
    SELECT * EXCLUDE (chosen), CASE WHEN chosen THEN 'train' ELSE 'validation' END AS split
    FROM split_pairs""", "split_pairs")
oracle("vocab_roundtrip", f"SELECT doc_id, {glue('ids')} AS ids FROM sum_ids", "sum_ids")
_blank = f"{trim('line')} = ''"
cte("lines", f"""
    SELECT doc_id, CAST(unnest(range(len(ls))) AS INT) AS line_no, unnest(ls) AS line
    FROM (SELECT doc_id, string_split_regex(text, '[.\n]') AS ls FROM docs)""", "docs")
cte("flags", f"""
    SELECT *, {_blank} AS blank, count(*) FILTER (WHERE NOT {_blank}) OVER (
        PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) > 0 AS begun FROM lines""", "lines")
cte("ends", """
    SELECT *, count(*) FILTER (WHERE blank AND begun) OVER (
        PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) > 0 AS ended FROM flags""", "flags")
oracle("assemble_lines", f"""
    SELECT doc_id, {trim("string_agg(line, ' ' ORDER BY line_no)")} AS text
    FROM ends WHERE NOT blank AND NOT ended GROUP BY doc_id""", "ends")
oracle("clean_text", f"""
    SELECT doc_id, {clean('text')} AS clean, {clean('text', bare=True)} AS bare,
        {clean('text', lower=False)} AS cased, {clean('text', emails_first=True)} AS emails_first
    FROM docs""", "docs")
oracle("strip_accents", "SELECT doc_id, strip_accents(text) AS bare FROM docs", "docs")
oracle("clean_text_light", f"SELECT doc_id, {light('text')} AS clean FROM docs", "docs")
oracle("tokenize", f"SELECT doc_id, {glue(words('text'))} AS words FROM docs", "docs")
oracle("word_count", f"SELECT doc_id, len({words('text')}) AS n_words FROM docs", "docs")
oracle("split_sentences", "SELECT * FROM raw_sentences", "raw_sentences")
oracle("split_fragments", "SELECT doc_id, idx, fragment FROM d_frags", "d_frags")
oracle("content_words", f"""
    SELECT doc_id, {glue(f"list_filter({words('t')}, lambda w: {is_content('w')})")} AS content
    FROM d_light""", "d_light")
oracle("encode", f"SELECT doc_id, {glue('ids')} AS ids FROM doc_ids", "doc_ids")
oracle("encode_with_markers", f"SELECT doc_id, {glue('ids')} AS ids FROM marked", "marked")
cte("marked_seq", "SELECT doc_id, ids AS seq FROM marked", "marked")
oracle("decode", f"""
    SELECT a.doc_id, a.summary AS text, b.summary AS with_specials
    FROM ({decoded('marked_seq')}) a JOIN ({decoded('marked_seq', specials=True)}) b ON a.doc_id = b.doc_id""",
    "marked_seq", "sum_vocab")
oracle("pad_post", f"SELECT doc_id, {glue(padded('ids', 100))} AS seq FROM marked", "marked")
oracle("pad_pre", f"""
    SELECT doc_id, {glue("list_resize([]::INT[], greatest(100 - len(ids), 0), 0) || ids[1:100]")} AS seq
    FROM marked""", "marked")
oracle("teacher_shift", f"""
    SELECT doc_id, {glue(padded('ids', 100) + '[1:99]')} AS decoder_in,
        {glue(padded('ids', 100) + '[2:100]')} AS decoder_target FROM marked""", "marked")
oracle("preview", """
    SELECT doc_id, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END AS preview,
        substring(text, 1, 100) || '...' AS list_view FROM docs""", "docs")
_nt, _ns = f"len({words(TEXT)})", f"len({words(SUMMARY)})"
oracle("compression_ratio", f"""
    SELECT doc_id, {r6(ratio(_ns, _nt))} AS ratio, {r6(f'({ratio(_ns, _nt)}) * 100')} AS percent
    FROM pairs""", "pairs")
oracle("rouge1", f"SELECT doc_id, {r6('p')} AS precision, {r6('r')} AS recall, {r6(F1)} AS f1 FROM pair_pr",
       "pair_pr")
oracle("comparison_report", f"""
    SELECT *, {_nt} AS text_words, {_ns} AS summary_words, {r6(ratio(_ns, _nt))} AS compression
    FROM pairs""", "pairs")
oracle("evaluation_report", f"""
    SELECT doc_id, {TEXT}, {SUMMARY}, generated, {_nt} AS text_words, {_ns} AS reference_words,
        len({words('generated')}) AS generated_words,
        {r6('p')} AS precision, {r6('r')} AS recall, {r6(F1)} AS f1 FROM triple_pr""", "triple_pr")
oracle("join_fragments", f"""
    SELECT doc_id, {joined_fragments('parts', 'len(parts)')} AS text, CAST(len(parts) AS INT) AS n_fragments
    FROM d_lists""", "d_lists")

oracle("min_words_filter", f"SELECT doc_id, len({words('text')}) AS n_words FROM docs WHERE len({words('text')}) >= 10",
       "docs")
oracle("valid_pairs", f"""
    SELECT * FROM turns WHERE {trim(f"coalesce({TEXT}, '')")} <> '' AND {trim(f"coalesce({SUMMARY}, '')")} <> ''""",
    "turns")
oracle("score_threshold", f"SELECT doc_id, idx, {r6('score')} AS score FROM scores WHERE score >= 0.5", "scores")
oracle("min_rows_check", "SELECT count(*) AS n, count(*) < 10 AS too_few FROM pairs", "pairs")
cte("two_steps", f"""
    SELECT doc_id, 1::BIGINT AS hyp_id, [2] AS seq, 0.0::DOUBLE AS score, false AS done, 0 AS step FROM pairs
    UNION ALL
    SELECT doc_id, rank, seq, score, done, step FROM (
        SELECT *, row_number() OVER (
            PARTITION BY doc_id ORDER BY round(score, 10) DESC, hyp_id, next) AS rank
        FROM (
            SELECT doc_id, hyp_id, next,
                CASE WHEN next IS NULL THEN seq ELSE list_append(seq, next) END AS seq,
                score + CASE WHEN next IS NULL THEN 0.0::DOUBLE ELSE ln(p + 1e-10::DOUBLE) END AS score,
                done OR next IS NULL OR next = 3 AS done, step + 1 AS step
            FROM two_steps LEFT JOIN top ON NOT done AND prev = seq[-1]
            WHERE step < 2))
    WHERE rank <= {BEAM}""", "pairs", "top")
oracle("exclude_finished", f"""
    SELECT doc_id, CAST(hyp_id AS INT) AS hyp_id, {glue('seq')} AS seq FROM two_steps WHERE step = 2 AND seq[-1] <> 3""",
    "two_steps")

oracle("token_id_lookup", """
    SELECT doc_id, pos, word, coalesce(id, 1) AS id FROM txt_words LEFT JOIN sum_vocab ON token = word""",
    "txt_words", "sum_vocab")
oracle("id_token_lookup", f"""
    SELECT doc_id, pos, x.id, coalesce(v.token, '<UNK>') AS token FROM (
        SELECT doc_id, pos, coalesce(id, 1) + CASE WHEN pos % 3 = 2 THEN {SUMMARY_WORDS} ELSE 0 END AS id
        FROM txt_words LEFT JOIN sum_vocab ON token = word) x LEFT JOIN sum_vocab v ON v.id = x.id""",
    "txt_words", "sum_vocab")
oracle("idf_lookup", f"""
    SELECT d.doc_id, d.word, {r6('coalesce(idf, 0.0::DOUBLE)')} AS idf FROM doc_seen d LEFT JOIN (
        SELECT word, ln((SELECT count(*) FROM benchmark)::DOUBLE / (1 + count(*))) AS idf
        FROM item_seen GROUP BY word) i ON i.word = d.word""", "doc_seen", "item_seen")
oracle("drop_stopwords", f"SELECT doc_id, idx, pos, word FROM d_fw WHERE {is_content('word')}", "d_fw")
oracle("keep_important", """
    SELECT doc_id, idx, pos, word FROM d_fw SEMI JOIN d_imp USING (doc_id, word)""", "d_fw", "d_imp")
oracle("holdout_rest", f"SELECT doc_id, {TEXT}, {SUMMARY} FROM split_pairs WHERE NOT chosen", "split_pairs")
oracle("align_pairs", "SELECT * FROM triples", "triples")

oracle("word_freq", "SELECT * FROM doc_freq", "doc_freq")
oracle("word_freq_merge", """
    SELECT coalesce(d.word, i.word) AS word, coalesce(d.freq, 0) + coalesce(i.freq, 0) AS freq,
        CASE WHEN d.word IS NULL THEN 1 ELSE 0 END AS first_batch,
        CASE WHEN d.word IS NULL THEN i.first_doc ELSE d.first_doc END AS first_doc,
        CASE WHEN d.word IS NULL THEN i.first_rank ELSE d.first_rank END AS first_rank
    FROM doc_freq d FULL JOIN item_freq i ON d.word = i.word""", "doc_freq", "item_freq")
oracle("doc_freq", "SELECT word, df FROM df", "df")
oracle("corpus_idf", f"SELECT word, df, {r6('idf')} AS idf FROM idf", "idf")
oracle("fragment_idf", f"SELECT doc_id, word, df, {r6('idf')} AS idf FROM d_idf", "d_idf")
oracle("fragment_word_freq", "SELECT * FROM d_cfreq", "d_cfreq")
oracle("term_freq", f"""
    SELECT doc_id, idx, word, count(*) AS c, {r6('count(*)::DOUBLE / any_value(n)')} AS tf, 'sentence' AS kind
    FROM sentence_words GROUP BY doc_id, idx, word UNION ALL
    SELECT doc_id, idx, word, c, {r6('c::DOUBLE / sum(c) OVER (PARTITION BY doc_id, idx)')}, 'fragment'
    FROM d_terms""",
    "sentence_words", "d_terms")
oracle("sentence_tfidf", f"SELECT doc_id, idx, {r6('score')} AS score FROM scores", "scores")
oracle("fragment_importance", f"""
    SELECT doc_id, CAST(n_fragments AS INT) AS n_fragments, idx, {r6('score')} AS score FROM d_scores""", "d_scores")
cte("lengths", f"SELECT len({words('text')}) AS x FROM docs", "docs")
oracle("length_stats", f"""
    SELECT count(*) AS n, {r6('avg(x)')} AS mean, {r6('quantile_cont(x, 0.5)')} AS median,
        CAST(min(x) AS INT) AS shortest, CAST(max(x) AS INT) AS longest, {r6('stddev_pop(x)')} AS std
    FROM lengths""", "lengths")
oracle("length_histogram", f"""
    SELECT b.bin, {r6('lo + (hi - lo) / 30 * (b.bin - 1)')} AS bin_from, {r6('lo + (hi - lo) / 30 * b.bin')} AS bin_to,
        count(x) AS n
    FROM (SELECT unnest(range(1, 31)) AS bin) b
    CROSS JOIN (SELECT min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi FROM lengths)
    LEFT JOIN lengths ON least(CAST(floor(30 * (x - lo) / (hi - lo)) AS INT) + 1, 30) = b.bin
    GROUP BY b.bin, lo, hi""", "lengths")
oracle("length_boxplot", f"""
    SELECT {r6('q1')} AS q1, {r6('median')} AS median, {r6('q3')} AS q3,
        {r6('least(min(x) FILTER (WHERE inside), q1)')} AS whisker_low,
        {r6('greatest(max(x) FILTER (WHERE inside), q3)')} AS whisker_high,
        count(*) FILTER (WHERE NOT inside) AS outliers
    FROM (SELECT *, x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM lengths CROSS JOIN (
        SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
        FROM lengths)) GROUP BY q1, median, q3""", "lengths")

# A fit by full gradients, round by round: feat has the share of each slot in a sentence, z the
# margins and w the weights of a round, with what the update rule remembers.
SLOTS, RATE = 65_536, 0.1
cte("lab", f"""
    SELECT doc_id, idx, quality AS y, {HASH_TRAIN} AS train FROM sentences JOIN labels USING (doc_id)
    WHERE quality IN (0, 1)""", "sentences")
cte("feat", f"""
    SELECT doc_id, idx, slot, sum(x) AS x FROM (
        SELECT doc_id, idx, ('0x' || substr(md5(word), 1, 8))::BIGINT % {SLOTS} AS slot, 1 / sqrt(n) AS x FROM sentence_words
        UNION ALL SELECT doc_id, idx, {SLOTS}, 1.0::DOUBLE FROM sentences) GROUP BY doc_id, idx, slot""",
    "sentences", "sentence_words")
cte("seen_feat", "SELECT f.*, y, train FROM feat f JOIN lab USING (doc_id, idx)", "feat", "lab")
cte("w0", "SELECT DISTINCT slot, 0.0::DOUBLE AS w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v FROM seen_feat WHERE train", "seen_feat")
for _r in range(1, ROUNDS + 1):
    cte(f"z{_r - 1}", f"""
        SELECT doc_id, idx, any_value(y) AS y, any_value(train) AS train, coalesce(sum(x * w), 0.0) AS z
        FROM seen_feat LEFT JOIN w{_r - 1} USING (slot) GROUP BY doc_id, idx""", "seen_feat", f"w{_r - 1}")
    cte(f"w{_r}", f"""
        SELECT slot, w - {RATE} * (m / {1 - 0.9**_r!r}::DOUBLE) / (sqrt(v / {1 - 0.999**_r!r}::DOUBLE) + 1e-7) AS w, m, v FROM (
            SELECT slot, w, 0.9::DOUBLE * m + 0.1::DOUBLE * g AS m, 0.999::DOUBLE * v + 0.001::DOUBLE * g * g AS v
            FROM w{_r - 1} JOIN (
                SELECT slot, sum(x * (1 / (1 + exp(-z)) - f.y)) / (SELECT count(*) FROM lab WHERE train) AS g
                FROM seen_feat f JOIN z{_r - 1} USING (doc_id, idx) WHERE f.train GROUP BY slot) USING (slot))""",
        "lab", f"w{_r - 1}", f"z{_r - 1}")
cte(f"z{ROUNDS}", f"""
    SELECT doc_id, idx, any_value(y) AS y, any_value(train) AS train, coalesce(sum(x * w), 0.0) AS z
    FROM seen_feat LEFT JOIN w{ROUNDS} USING (slot) GROUP BY doc_id, idx""", "seen_feat", f"w{ROUNDS}")
_loss = "ln(1 + exp(CASE y WHEN 1 THEN -z ELSE z END))"
_hit = "CAST((z > 0) = (y = 1) AS INT)"
_of = lambda v, part: f"avg({v}) FILTER (WHERE {part})"
cte("history", " UNION ALL ".join(f"""
    SELECT {r} AS epoch, {_of(_loss, 'train')} AS loss, {_of(_loss, 'NOT train')} AS val_loss,
        {_of(_hit, 'train')} AS accuracy, {_of(_hit, 'NOT train')} AS val_accuracy, {RATE}::DOUBLE AS rate FROM z{r}"""
    for r in range(1, ROUNDS + 1)), *(f"z{r}" for r in range(1, ROUNDS + 1)))
_columns = ("loss", "val_loss", "accuracy", "val_accuracy")
oracle("training_history", f"""
    SELECT epoch, {", ".join(f"{r6(c)} AS {c}" for c in (*_columns, "rate"))} FROM history""", "history")
oracle("training_report", f"""
    SELECT count(*) AS epochs, {", ".join(f"{r6(f'arg_max({c}, epoch)')} AS last_{c}" for c in _columns)},
        {r6('min(val_loss)')} AS best_val_loss, {r6('max(val_accuracy)')} AS best_val_accuracy FROM history""", "history")
cte("fitted", f"""
    SELECT slot, w FROM ({" UNION ALL ".join(f"SELECT {r} AS epoch, slot, w FROM w{r}" for r in range(1, ROUNDS + 1))})
    WHERE epoch = (SELECT arg_min(epoch, val_loss) FROM history)""", "history", *(f"w{r}" for r in range(1, ROUNDS + 1)))
cte("classified", f"""
    SELECT doc_id, idx, {r6('1 / (1 + exp(-coalesce(sum(x * w), 0.0)))')} AS score
    FROM feat LEFT JOIN fitted USING (slot) GROUP BY doc_id, idx""", "feat", "fitted")
oracle("classifier_fit_score", "SELECT doc_id, idx, score FROM classified", "classified")
oracle("classifier_top_n", f"""
    SELECT doc_id, idx, score, rank FROM (
        SELECT *, CAST(row_number() OVER ({BEST_FIRST}) AS INT) AS rank FROM classified WHERE score >= 0.5)
    WHERE rank <= 5""", "classified")
cte("ws", f"SELECT doc_id, {words('text')} AS ws FROM docs", "docs")
cte("said", f"""
    SELECT quality = 1 AS truth, {ratio('len(list_distinct(ws))', 'len(ws)')} > 0.5 AS said
    FROM ws JOIN labels USING (doc_id)""", "ws")
_n = lambda cond: f"count(*) FILTER (WHERE {cond})"
oracle("binary_metrics", f"""
    SELECT count(*) AS n, {r6(ratio(_n('said = truth'), 'count(*)'))} AS accuracy,
        {r6(ratio(_n('said AND truth'), _n('said')))} AS precision,
        {r6(ratio(_n('said AND truth'), _n('truth')))} AS recall FROM said""", "said")
cte("guessed", """
    SELECT s.next AS target, coalesce(b.next, 0) AS guess FROM padded_steps s LEFT JOIN best b ON b.prev = s.prev""",
    "padded_steps", "best")
oracle("token_accuracy", " UNION ALL ".join(f"""
    SELECT count(*) AS n, {_n('target = guess')} AS "right", {r6(ratio(_n('target = guess'), 'count(*)'))} AS accuracy,
        '{kind}' AS kind FROM {source} {where}""" for kind, source, where in (
        ("all", "guessed", ""), ("no padding", "guessed", "WHERE target <> 0"))), "guessed")
oracle("distinct_words", "SELECT doc_id, word FROM doc_seen", "doc_seen")
oracle("count_rows", """
    SELECT CASE WHEN chosen THEN 'train' ELSE 'validation' END AS split, count(*) AS n
    FROM split_pairs GROUP BY chosen""", "split_pairs")

oracle("vocabulary", "SELECT * FROM doc_vocab", "doc_vocab")
vocab_cte("few_vocab", "doc_freq", BOUNDED_WORDS)
oracle("vocabulary_bounded", "SELECT * FROM few_vocab", "few_vocab")
oracle("top_words", "SELECT word, freq FROM doc_freq ORDER BY freq DESC, first_doc, first_rank LIMIT 20", "doc_freq")
oracle("important_words", "SELECT * FROM d_imp", "d_imp")
cte("ranked", f"SELECT *, CAST(row_number() OVER ({BEST_FIRST}) AS INT) AS rank FROM scores", "scores")
cte("ranked_over", f"""
    SELECT *, CAST(row_number() OVER ({BEST_FIRST}) AS INT) AS rank FROM scores WHERE score >= 0.5""", "scores")
oracle("tfidf_top_n", f"SELECT doc_id, idx, {r6('score')} AS score, rank FROM ranked WHERE rank <= 5", "ranked")
oracle("threshold_top_n", f"SELECT doc_id, idx, {r6('score')} AS score, rank FROM ranked_over WHERE rank <= 5",
       "ranked_over")
oracle("adaptive_k", f"""
    SELECT doc_id, CAST(len(parts) AS INT) AS n_fragments, {adaptive_k('len(parts)')} AS k FROM d_lists""", "d_lists")
oracle("rank_then_restore", f"SELECT doc_id, {glue('kept')} AS kept FROM d_kept", "d_kept")
oracle("last_rows", f"""
    SELECT row_number() OVER (ORDER BY doc_id) AS number, doc_id, {TEXT}, {SUMMARY} FROM pairs
    ORDER BY doc_id DESC LIMIT 3""", "pairs")
oracle("extractive_summary", """
    SELECT doc_id, summary, n_fragments, CAST(len(chosen) AS INT) AS n_kept FROM d_summary""", "d_summary")

_items = f"""
    SELECT item_id, text, text FROM benchmark"""
oracle("union_pairs", f"SELECT doc_id, {TEXT}, {SUMMARY} FROM pairs UNION ALL {_items} UNION ALL {_items}", "pairs")
oracle("split_exact", """
    SELECT doc_id, CASE WHEN chosen THEN 'train' ELSE 'validation' END AS split FROM split_docs""", "split_docs")
oracle("split_hash", f"""
    SELECT doc_id, CASE WHEN {HASH_TRAIN} THEN 'train' ELSE 'validation' END AS split FROM docs""", "docs")
oracle("split_fallback", """
    SELECT * EXCLUDE (chosen), CASE WHEN chosen THEN 'validation' ELSE 'train' END AS split
    FROM split_back""", "split_back")
_shared = f"list_sort(list_distinct(list_intersect({words(TEXT)}, {words(SUMMARY)})))"
oracle("set_overlap", f"SELECT doc_id, {glue(_shared)} AS shared, len({_shared}) AS n FROM pairs", "pairs")

# Training tables: vocabularies from the training rows, applied to all rows.
cte("train_pairs", f"""
    SELECT doc_id, {clean(TEXT)} AS {TEXT}, {clean(SUMMARY)} AS {SUMMARY} FROM split_pairs WHERE chosen""",
    "split_pairs")
token_ctes("trt", "train_pairs", TEXT)
token_ctes("trs", "train_pairs", SUMMARY)
vocab_cte("trt_vocab", "trt_freq", TEXT_WORDS)
vocab_cte("trs_vocab", "trs_freq", SUMMARY_WORDS)
ids_cte("all_txt_ids", "txt", "trt_vocab")
ids_cte("all_sum_ids", "sum", "trs_vocab")
_target = padded("([2] || s.ids || [3])", 100)
oracle("prepare_seq2seq", f"""
    SELECT t.doc_id, {glue(padded('t.ids', 500))} AS encoder_in, {glue(_target + '[1:99]')} AS decoder_in,
        {glue(_target + '[2:100]')} AS decoder_target
    FROM all_txt_ids t JOIN all_sum_ids s ON s.doc_id = t.doc_id""", "all_txt_ids", "all_sum_ids")
oracle("fit_two_vocabularies", f"""
    SELECT *, '{TEXT}' AS side FROM trt_vocab UNION ALL SELECT *, '{SUMMARY}' FROM trs_vocab""",
    "trt_vocab", "trs_vocab")
oracle("encode_for_inference", f"SELECT doc_id, {glue(padded('ids', 500))} AS encoder_in FROM doc_ids", "doc_ids")
cte("tfidf_lists", """
    SELECT d.doc_id, coalesce(parts, []) AS parts FROM docs d LEFT JOIN (
        SELECT doc_id, list(sentence ORDER BY rank) AS parts FROM ranked WHERE rank <= 5 GROUP BY doc_id
    ) r ON r.doc_id = d.doc_id""", "docs", "ranked")
oracle("summarize_batch", f"""
    SELECT 'extractive' AS strategy, doc_id, summary FROM d_summary UNION ALL
    SELECT 'tfidf', doc_id, {joined_fragments('parts', 'len(parts)')} FROM tfidf_lists UNION ALL
    SELECT 'greedy', doc_id, summary FROM ({decoded('greedy_end')}) UNION ALL
    SELECT 'beam_search', doc_id, summary FROM ({decoded('beam_end')})""",
    "d_summary", "tfidf_lists", "greedy_end", "beam_end", "sum_vocab")
_nd, _nk = f"len({words('text')})", f"len({words('summary')})"
oracle("summarize_and_log", f"""
    SELECT '0-' || doc_id AS doc_id, summary AS {SUMMARY}, 'summary' AS source, {_nd} AS text_words, {_nk} AS summary_words,
        {r6(f'({ratio(_nk, _nd)}) * 100')} AS percent
    FROM docs JOIN d_summary USING (doc_id) WHERE {_nd} >= 10""", "docs", "d_summary")

oracle("next_token_table", f"SELECT prev, next, {r6('p')} AS p FROM probs", "probs")
oracle("greedy_decode", f"SELECT doc_id, {glue('seq')} AS seq, {r6('score')} AS score FROM greedy_end", "greedy_end")
oracle("beam_search", f"SELECT doc_id, {glue('seq')} AS seq, {r6('score')} AS score FROM beam_end", "beam_end")

# Alignments: the cells of all pairs, and the table of each round.
cte("pair_words", f"SELECT doc_id, {words(TEXT)} AS xs, {words(SUMMARY)} AS ys FROM clean_pairs", "clean_pairs")
cte("text_words", """
    SELECT doc_id, word, count(*) AS n, any_value(size) AS size
    FROM (SELECT doc_id, unnest(xs || ['']) AS word, len(xs) + 1 AS size FROM pair_words) GROUP BY doc_id, word""", "pair_words")
cte("cells", """
    SELECT t.doc_id, word, summary_word, n, m, size FROM text_words t JOIN (
        SELECT doc_id, summary_word, count(*) AS m FROM (SELECT doc_id, unnest(ys) AS summary_word FROM pair_words)
        GROUP BY doc_id, summary_word) s ON t.doc_id = s.doc_id""", "text_words", "pair_words")
cte("t0", """
    SELECT DISTINCT word, summary_word, 1.0::DOUBLE / (SELECT count(DISTINCT summary_word) FROM cells) AS p FROM cells""", "cells")
for _r in range(1, ALIGN_ROUNDS + 1):
    cte(f"share{_r}", f"""
        SELECT word, summary_word, sum(m * n * p / total) AS c, sum(m * n * p / total * ln(total / size)) AS l FROM (
            SELECT *, sum(n * p) OVER (PARTITION BY doc_id, summary_word) AS total FROM cells JOIN t{_r - 1} USING (word, summary_word))
        GROUP BY word, summary_word""", "cells", f"t{_r - 1}")
    cte(f"t{_r}", f"SELECT word, summary_word, c / sum(c) OVER (PARTITION BY word) AS p FROM share{_r}", f"share{_r}")
oracle("word_alignment", f"SELECT word, summary_word, {r6('p')} AS p FROM t{ALIGN_ROUNDS} WHERE {r6('p')} >= {LEAST_P}", f"t{ALIGN_ROUNDS}")
oracle("alignment_history", " UNION ALL ".join(
    f'SELECT {r} AS "round", round(sum(l), 3) AS log_likelihood FROM share{r}' for r in range(1, ALIGN_ROUNDS + 1)),
    *(f"share{r}" for r in range(1, ALIGN_ROUNDS + 1)))
oracle("likely_summary_words", f"""
    SELECT doc_id, CAST(rank AS INT) AS rank, summary_word, {r6('p')} AS p FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, summary_word) AS rank FROM (
            SELECT doc_id, summary_word, round(sum(n * p) / any_value(size), 10) AS p
            FROM text_words JOIN t{ALIGN_ROUNDS} USING (word) GROUP BY doc_id, summary_word))
    WHERE rank <= 10""", "text_words", f"t{ALIGN_ROUNDS}")


# Back-off over prefixes of two ids, of one and of none; names end in _a for all summaries and _t for the training part.
def backoff_ctes(suffix: str, where: str) -> None:
    def order(n: int, source: str, prefix: str) -> None:
        keys = f"{prefix}, w" if prefix else "w"
        cte(f"k{n}{suffix}", f"SELECT {keys}, count(*) AS c FROM {source} {where if n == 3 else ''} GROUP BY {keys}", source)
        cte(f"d{n}{suffix}", f"""
            SELECT CASE WHEN one = 0 OR two = 0 THEN 0.5::DOUBLE ELSE one::DOUBLE / (one + 2 * two) END AS d FROM (
                SELECT count(*) FILTER (WHERE c = 1) AS one, count(*) FILTER (WHERE c = 2) AS two FROM k{n}{suffix})""", f"k{n}{suffix}")
        cte(f"s{n}{suffix}", f"SELECT {prefix + ', ' if prefix else ''}sum(c) AS s, count(*) AS t FROM k{n}{suffix} {'GROUP BY ' + prefix if prefix else ''}",
            f"k{n}{suffix}")

    order(3, "thirds", "u, v")
    order(2, f"k3{suffix}", "v")
    order(1, f"k2{suffix}", "")


def backoff_p(suffix: str, rows: str) -> tuple[str, list[str]]:
    """The rows with p, and what that needs."""
    names = [f"{x}{n}{suffix}" for n in (1, 2, 3) for x in "kds"]
    level = lambda n, lower: (
        f"CASE WHEN s{n}.s IS NULL THEN {lower} ELSE (greatest(coalesce(k{n}.c, 0) - d{n}.d, 0.0) + d{n}.d * s{n}.t * {lower}) / s{n}.s END")
    return f"""
        SELECT r.*, {level(3, level(2, level(1, f'(1.0::DOUBLE / (SELECT count(*) + 1 FROM k1{suffix}))')))} AS p FROM ({rows}) r
        LEFT JOIN k3{suffix} k3 USING (u, v, w) LEFT JOIN s3{suffix} s3 USING (u, v) LEFT JOIN k2{suffix} k2 USING (v, w)
        LEFT JOIN s2{suffix} s2 USING (v) LEFT JOIN k1{suffix} k1 USING (w), s1{suffix} s1, d1{suffix} d1, d2{suffix} d2, d3{suffix} d3""", names


cte("thirds", f"""
    SELECT doc_id, s[i] AS u, s[i + 1] AS v, s[i + 2] AS w, train FROM (
        SELECT doc_id, [2] || ids AS s, unnest(range(1, len(ids))) AS i, {HASH_TRAIN} AS train FROM marked)""", "marked")
backoff_ctes("_a", "")
backoff_ctes("_t", "WHERE train")
_sql, _names = backoff_p("_a", "SELECT u, v, w FROM k3_a")
oracle("backoff_table", f"SELECT u, v, w, {r6('p')} AS p FROM ({_sql})", *_names)
_sql, _names = backoff_p("_t", "SELECT doc_id, u, v, w FROM thirds WHERE NOT train")
oracle("backoff_likelihood", f"""
    SELECT doc_id, count(*) AS n, round(sum(ln(p)), 4) AS log_p FROM ({_sql}) GROUP BY doc_id""", *_names, "thirds")

# Naive Bayes over the words of sentences with a quality label.
cte("said_words", """
    SELECT word, count(*) FILTER (WHERE quality = 1) AS a, count(*) FILTER (WHERE quality = 0) AS b
    FROM sentence_words JOIN labels USING (doc_id) WHERE quality IN (0, 1) GROUP BY word""", "sentence_words")
cte("salience", """
    SELECT s.doc_id, s.idx, s.sentence, 1 / (1 + exp(-(prior + coalesce(total, 0.0::DOUBLE)))) AS score
    FROM sentences s CROSS JOIN (
        SELECT ln((count(*) FILTER (WHERE quality = 1) + 1)::DOUBLE / (count(*) FILTER (WHERE quality = 0) + 1)) AS prior
        FROM sentences JOIN labels USING (doc_id))
    LEFT JOIN (
        SELECT doc_id, idx, sum(weight) AS total FROM sentence_words JOIN (
            SELECT word, ln((a + 1) / (sum(a) OVER () + count(*) OVER ())::DOUBLE)
                - ln((b + 1) / (sum(b) OVER () + count(*) OVER ())::DOUBLE) AS weight
            FROM said_words) w USING (word) GROUP BY doc_id, idx
    ) t ON t.doc_id = s.doc_id AND t.idx = s.idx""", "sentences", "sentence_words", "said_words")
oracle("salience_fit_score", f"SELECT doc_id, idx, {r6('score')} AS score FROM salience", "salience")
oracle("salience_top_n", f"""
    SELECT doc_id, idx, {r6('score')} AS score, rank FROM (
        SELECT *, CAST(row_number() OVER ({BEST_FIRST}) AS INT) AS rank FROM salience WHERE score >= 0.5)
    WHERE rank <= 5""", "salience")
