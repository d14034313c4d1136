"""The same results as ``queries`` in SQL for DuckDB, written independently of Spark."""

from __future__ import annotations

from textloom.catalog.fixtures import PLAIN_SOURCES, TOKENIZER, WINNERS
from textloom.functions.symbols import BYTE_TO_ID, FIRST_BYTE_ID, SPECIALS, id_to_symbol, printable
from textloom.functions.text import PY_WHITESPACE

LEARNED = 16
EOS, PAD = SPECIALS["</s>"], SPECIALS["<pad>"]
SEP = "chr(1)"
# A character the texts do not hold; marks where a whitespace run must be cut.
CUT = "\ue000"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
BYTE_IDS = "[" + ",".join(str(BYTE_TO_ID[b]) for b in range(256)) + "]"
BYTE_SYMBOLS = "[" + ",".join(f"'{id_to_symbol(BYTE_TO_ID[b])}'" for b in range(256)) + "]"
SEP_SYMBOL = id_to_symbol(BYTE_TO_ID[1])


def strip(x: str) -> str:
    return f"trim({x}, '{PY_WHITESPACE}')"


def prefixed(x: str) -> str:
    return f"CASE WHEN {x} = '' OR starts_with({x}, ' ') THEN {x} ELSE ' ' || {x} END"


def pretokens(x: str) -> str:
    """List of pretokens of a text that already has its prefix space."""
    cut = f"regexp_replace({x}, '(\\s)(\\s)(\\S)', '\\1{CUT}\\2\\3', 'g')"
    pattern = PATTERN.replace("'", "''")
    return f"flatten(list_transform(string_split({cut}, '{CUT}'), lambda p: regexp_extract_all(p, '{pattern}')))"


def byte_ids(x: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({x})), '..'), lambda h: {BYTE_IDS}[('0x' || h)::INT + 1])"


def symbols(words: str) -> str:
    """A list of pretokens as one symbol string with separators."""
    joined = f"array_to_string({words}, {SEP})"
    return f"array_to_string(list_transform(regexp_extract_all(hex(encode({joined})), '..'), lambda h: {BYTE_SYMBOLS}[('0x' || h)::INT + 1]), '')"


def merged(x: str) -> str:
    for (a, b), made in zip(TOKENIZER.merges, TOKENIZER.merge_results, strict=True):
        x = f"replace({x}, '{id_to_symbol(a)}{id_to_symbol(b)}', '{id_to_symbol(made)}')"
    return f"replace({x}, '{SEP_SYMBOL}', '')"


def symbol_ids(x: str) -> str:
    return f"list_transform(list_filter(string_split({x}, ''), lambda s: s <> ''), lambda s: unicode(s) - 256)"


def encoded(x: str) -> str:
    """Ids of a text without special strings under the short merge list."""
    return symbol_ids(merged(symbols(pretokens(prefixed(x)))))


def byte_encoded(x: str) -> str:
    return byte_ids(prefixed(x))


def hashed(key: str) -> str:
    return f"('0x' || substr(md5('42:' || {key}), 1, 15))::BIGINT"


def total(ids: str) -> str:
    return f"coalesce(list_sum({ids}), 0)::BIGINT"


def digest(ids: str) -> str:
    return f"md5(array_to_string({ids}, ','))"


def ones(n: str) -> str:
    return f"list_resize([1], {n}, 1)"


def id_summary(keys: str, source: str, ids: str = "ids") -> str:
    return f"SELECT {keys}, len({ids})::INT AS n_ids, {digest(ids)} AS digest FROM {source}"


def block_rows(source: str, keys: str, size: int = 1024) -> str:
    """CTE body: one row per block with its unpadded slice ``part``."""
    return (
        f"SELECT {keys}, b::INT AS block_no, ids[b * {size} + 1 : (b + 1) * {size}] AS part FROM "
        f"(SELECT *, unnest(range(0, (len(ids) + {size - 1}) // {size})) AS b FROM {source})"
    )


def block_summary(keys: str, source: str, width: str = "1024") -> str:
    padded = f"list_resize(part, {width}, {PAD})"
    mask = f"list_resize({ones('len(part)')}, {width}, 0)"
    return (
        f"SELECT {keys}, ({width})::INT AS width, len(part)::BIGINT AS n_tokens, "
        f"{digest(padded)} AS ids_digest, {digest(mask)} AS mask_digest FROM {source}"
    )


def pick(label: str, index: tuple[str, ...]) -> str:
    return "[" + ",".join(f"'{v}'" for v in index) + f"][({label}) + 1]"


ORACLES: dict[str, str] = {}

# The corpus of five sources

CORPUS = "corpus AS (" + " UNION ALL ".join(
    [
        f"SELECT '{n}' AS source, doc_id AS id, {strip('text')} AS text FROM documents WHERE doc_id % 3 = {i}"
        for i, n in enumerate(PLAIN_SOURCES)
    ]
    + [
        f"SELECT '{n}' AS source, u.conv_id * 100 + u.turn AS id, {strip("u.text || ' ' || a.text")} AS text "
        "FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 "
        f"WHERE u.role = 'user' AND a.role = 'assistant' AND u.conv_id % 2 = {i}"
        for i, n in enumerate(("code", "qa"))
    ]
) + ")"
# Written text ends with a newline, so the last piece of a split is no line.
LINES = "lines AS (SELECT source, unnest(string_split(text, chr(10))) || chr(10) AS text FROM corpus)"


def pretoken_table(source: str) -> str:
    return f"SELECT pretoken, count(*) AS n FROM (SELECT unnest({pretokens(prefixed('text'))}) AS pretoken FROM {source}) GROUP BY 1"


ORACLES["source_scan"] = f"SELECT 'documents' AS source, doc_id AS id, {strip('text')} AS text FROM documents"
ORACLES["source_builders"] = f"WITH {CORPUS} SELECT source, count(*) AS rows, sum(length(text))::BIGINT AS chars FROM corpus GROUP BY 1"
RANKED = "SELECT doc_id, n_chars, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM documents"
ORACLES["head_fraction"] = f"SELECT doc_id, n_chars FROM ({RANKED}) WHERE r <= round_even(0.1::DOUBLE * n, 0)"
ORACLES["head_rows"] = f"SELECT doc_id, n_chars FROM ({RANKED}) WHERE r <= 100"
ORACLES["head_rows_by_text"] = "SELECT source || ':' || doc_id AS name, lang FROM documents ORDER BY 1 LIMIT 60"
BYTE_BLOCKS = (
    f"d AS (SELECT doc_id, list_append({byte_encoded('text')}, {EOS}) AS ids FROM documents), "
    f"b AS ({block_rows('d', 'doc_id')})"
)
ORACLES["block_glob_scan"] = f"WITH {BYTE_BLOCKS} {block_summary('doc_id, block_no', 'b')}"
N_BYTES = f"(octet_length(encode({prefixed('text')})) + 1)"
ORACLES["sorted_block_shards"] = f"SELECT doc_id, ceil({N_BYTES} / 1024.0)::BIGINT AS n_blocks, {N_BYTES}::BIGINT AS n_tokens, true AS sorted_in_files, true AS files_apart FROM documents"
ORACLES["text_sink"] = f"WITH {CORPUS}, {LINES} SELECT source, count(*) AS lines, sum(length(text))::BIGINT AS chars FROM lines GROUP BY 1"
ORACLES["line_pretoken_counts"] = f"WITH {CORPUS}, {LINES} {pretoken_table('lines')}"
ORACLES["incremental_table"] = "SELECT doc_id, length(text)::INT AS chars FROM documents"
ORACLES["materialize_once"] = f"WITH {CORPUS} SELECT source, id, length(text)::INT AS chars FROM corpus"
RAGGED = "'　' || chr(9) || text || ' ' || chr(28) || chr(10) || chr(133)"
ORACLES["strip_text"] = f"SELECT doc_id, {strip(RAGGED)} AS text FROM documents"
ORACLES["compose_text"] = f"WITH {CORPUS} SELECT id, text FROM corpus WHERE source IN ('code', 'qa')"
ORACLES["keep_text"] = (
    f"WITH {CORPUS} SELECT source, count(*) AS rows, count(*) FILTER (WHERE source NOT IN ('code', 'qa')) AS kept FROM corpus GROUP BY 1"
)
ORACLES["drop_long_text"] = "SELECT doc_id, n_chars FROM documents WHERE length(text) <= 4096"
FIRST_LINE = "split_part(text, chr(10), 1)"
REST = f"substr(text, length({FIRST_LINE}) + 2)"
INSTRUCTIONS = f"ins AS (SELECT doc_id AS id, {FIRST_LINE} AS instruction, {REST} AS input FROM documents)"
ORACLES["drop_empty_text"] = f"WITH {INSTRUCTIONS} SELECT id, length(input)::INT AS chars FROM ins WHERE length(input) > 0"
ORACLES["english_conversations"] = "SELECT doc_id AS id, len(string_split(text, chr(10)))::INT AS turns FROM documents WHERE lang = 'en'"
DOC_IDS = f"d AS (SELECT doc_id, {encoded('text')} AS ids FROM documents)"
ORACLES["token_band"] = f"WITH {DOC_IDS} SELECT doc_id, len(ids)::INT AS length FROM d WHERE len(ids) > 20 AND len(ids) <= 1024"
ORACLES["comparable_records"] = (
    "SELECT doc_id AS id, len(string_split(text, chr(10)))::INT AS n FROM documents WHERE len(string_split(text, chr(10))) >= 2"
)


def side(winner: str, key: str, a: str = "'a'", b: str = "'b'") -> str:
    return (
        f"CASE WHEN {winner} = 'model_a' THEN {a} WHEN {winner} = 'model_b' THEN {b} "
        f"WHEN {hashed(key)} % 2 = 0 THEN {a} ELSE {b} END"
    )


ORACLES["winner_choice"] = (
    f"SELECT id, winner, {side('winner', 'id')} AS side FROM (SELECT doc_id AS id, {pick('doc_id % 4', WINNERS)} AS winner FROM documents)"
)
ORACLES["id_range_check"] = (
    f"WITH {DOC_IDS} SELECT doc_id, true AS in_vocabulary, coalesce(list_max(ids), 0) < 260 AS bytes_only FROM d"
)

# Preference pairs and generations

PAIRS = """ans AS (SELECT conv_id AS id, turn, text, (length(text) % 10) / 2.0 AS score FROM conversations WHERE role = 'assistant'),
ask AS (SELECT conv_id AS id, arg_min(text, turn) AS instruction FROM conversations WHERE role = 'user' GROUP BY 1),
pairs AS (SELECT id, instruction, chosen, rejected FROM (
  SELECT id, first(text ORDER BY score DESC, turn) AS chosen, last(text ORDER BY score DESC, turn) AS rejected
  FROM ans GROUP BY 1 HAVING count(*) >= 2) JOIN ask USING (id)),
gen AS (SELECT id AS prompt_id, model, 'Instruction: ' || instruction || chr(10) || 'Response:' AS prompt, answer,
  'Instruction: ' || instruction || chr(10) || 'Response: ' || answer AS output FROM (
  SELECT id, instruction, 'tuned' AS model, chosen AS answer FROM pairs UNION ALL SELECT id, instruction, 'base', rejected FROM pairs))"""
LAST_ANSWER = strip("list_last(string_split(output, 'Response:'))")
ANSWERS = (
    "SELECT conv_id AS prompt_id, turn // 4 AS sample_id, turn // 2 % 2 = 0 AS tuned, 'prompt ' || conv_id AS prompt, "
    f"{strip('text')} AS response FROM conversations WHERE role = 'assistant'"
)
ORACLES["model_comparison"] = (
    f"WITH a AS ({ANSWERS}) SELECT prompt_id, sample_id, coalesce(b.prompt, t.prompt) AS prompt, b.response AS base_response, "
    "t.response AS tuned_response FROM (SELECT * FROM a WHERE NOT tuned) b FULL JOIN (SELECT * FROM a WHERE tuned) t USING (prompt_id, sample_id)"
)
ORACLES["zipped_responses"] = (
    "SELECT doc_id, (i - 1)::INT AS position, 'Instruction: ' || l[i] || chr(10) || 'Response: ' || l[len(l) + 1 - i] AS text "
    "FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"
)
ORACLES["keyed_responses"] = (
    "SELECT u.conv_id, u.turn, 'Instruction: ' || u.text || chr(10) || 'Response: ' || a.text AS text FROM conversations u "
    "JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'"
)
ORACLES["dictionary_lookup"] = (
    f"WITH p AS (SELECT doc_id, {pretokens(prefixed('text'))} AS words FROM documents) "
    f"SELECT doc_id, len(words)::BIGINT AS n_pretokens, length({merged(symbols('words'))})::BIGINT AS n_tokens FROM p"
)

# Order

ORACLES["corpus_union"] = f"WITH {CORPUS} SELECT source, id, text FROM corpus"
ORACLES["seeded_hashes"] = f"SELECT doc_id, {hashed('doc_id')} AS h FROM documents"
SHUFFLED = f"SELECT doc_id, lang, row_number() OVER (ORDER BY {hashed('doc_id')}, doc_id) - 1 AS row_index, count(*) OVER () AS n FROM documents"
ORACLES["shuffled_order"] = f"SELECT doc_id, lang, row_index FROM ({SHUFFLED})"
ORACLES["shuffled_shards"] = f"SELECT doc_id, ({hashed('doc_id')} // {(1 << 60) // 16 + 1})::INT AS shard FROM documents"
ORACLES["uniform_sample"] = f"SELECT doc_id, lang FROM ({SHUFFLED}) WHERE row_index < 50"
ORACLES["exact_split"] = (
    f"SELECT doc_id, lang, CASE WHEN row_index < ceil(0.1::DOUBLE * n) THEN 'test' ELSE 'train' END AS split FROM ({SHUFFLED})"
)
BEST = (
    "SELECT doc_id AS id, source AS instruction, first(l ORDER BY s DESC, i) AS chosen, last(l ORDER BY s DESC, i) AS rejected, count(*) AS n FROM "
    "(SELECT doc_id, source, i, l, (length(l) % 10) / 2.0 AS s FROM (SELECT doc_id, source, unnest(ls) AS l, unnest(range(1, len(ls) + 1)) AS i "
    "FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents))) GROUP BY 1, 2"
)
ORACLES["best_and_worst_completion"] = f"SELECT id, chosen, rejected FROM ({BEST})"
ORACLES["batch_assignment"] = f"SELECT doc_id, row_index // 16 AS batch_id, row_index // 16 < n // 16 AS in_full_batch FROM ({SHUFFLED})"

# Vocabulary and tokens

ORACLES["pretoken_lists"] = (
    f"SELECT doc_id, len(p)::INT AS n, md5(array_to_string(p, {SEP})) AS digest FROM (SELECT doc_id, {pretokens(prefixed('text'))} AS p FROM documents)"
)
ORACLES["byte_alphabet"] = f"SELECT token_id::INT AS token_id, count(*) AS n FROM (SELECT unnest({byte_ids('text')}) AS token_id FROM documents) GROUP BY 1"
ORACLES["pretoken_counts"] = pretoken_table("documents")


def learning() -> str:
    """One CTE per round: all pairs counted anew, the leading one replaced everywhere."""
    ctes = [f"c AS ({pretoken_table('documents')})", f"w0 AS MATERIALIZED (SELECT {symbols('[pretoken]')} AS w, n FROM c)"]
    for i in range(LEARNED):
        pairs = f"SELECT substr(w, k, 2) AS pair, n FROM (SELECT w, n, unnest(range(1, length(w))) AS k FROM w{i})"
        ctes.append(f"p{i} AS MATERIALIZED (SELECT pair FROM ({pairs}) GROUP BY 1 ORDER BY sum(n) DESC, pair COLLATE \"C\" LIMIT 1)")
        ctes.append(f"w{i + 1} AS MATERIALIZED (SELECT replace(w, pair, '{id_to_symbol(260 + i)}') AS w, n FROM w{i}, p{i})")
    ctes.append("learned AS (" + " UNION ALL ".join(f"SELECT {i} AS rank, pair FROM p{i}" for i in range(LEARNED)) + ")")
    names = [*SPECIALS, *(printable(bytes([b])) for b in sorted(BYTE_TO_ID, key=BYTE_TO_ID.get))]
    listed = ",".join("'" + n.replace("'", "''") + "'" for n in names)
    ctes.append(f"v0 AS (SELECT [{listed}] AS v)")
    for i in range(LEARNED):
        ctes.append(f"v{i + 1} AS (SELECT list_append(v, v[unicode(pair[1]) - 255] || v[unicode(pair[2]) - 255]) AS v FROM v{i}, p{i})")
    return "WITH " + ", ".join(ctes)


V = f"v{LEARNED}"
ORACLES["learned_merges"] = (
    f"{learning()} SELECT rank::INT AS rank, v[unicode(pair[1]) - 255] AS \"left\", v[unicode(pair[2]) - 255] AS \"right\", (260 + rank)::INT AS token_id FROM learned, {V}"
)
VOCAB = (
    f"SELECT (i - 1)::INT AS token_id, v[i] AS token, CASE WHEN i <= {FIRST_BYTE_ID} THEN 'special' WHEN i <= 260 THEN 'byte' ELSE 'merge' END AS kind "
    f"FROM (SELECT v, unnest(range(1, len(v) + 1)) AS i FROM {V})"
)
ORACLES["vocabulary_table"] = f"{learning()} {VOCAB}"
ORACLES["saved_vocabulary"] = f"{learning()} SELECT *, token_id = {PAD} AS is_pad FROM ({VOCAB})"
ORACLES["encode_text"] = f"WITH {DOC_IDS} {id_summary('doc_id', 'd')}"
ORACLES["dictionary_ids"] = ORACLES["encode_text"]
ORACLES["encode_with_specials"] = (
    f"WITH l AS (SELECT doc_id, i, CASE WHEN i > 1 THEN [{EOS}] ELSE [] END || {encoded('line')} AS ids FROM "
    "(SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))), "
    f"d AS (SELECT doc_id, list_append(flatten(list(ids ORDER BY i)), {EOS}) AS ids FROM l GROUP BY 1) {id_summary('doc_id', 'd')}"
)
DOC_EOS = f"d AS (SELECT doc_id, list_append({encoded('text')}, {EOS}) AS ids FROM documents)"
DOC_BLOCKS = f"{DOC_EOS}, b AS ({block_rows('d', 'doc_id')})"
ORACLES["token_blocks"] = f"WITH {DOC_BLOCKS} {block_summary('doc_id, block_no', 'b')}"
ORACLES["streamed_blocks"] = ORACLES["token_blocks"]
ORACLES["truncated_ids"] = f"WITH {DOC_IDS} {id_summary('doc_id', '(SELECT doc_id, ids[1:1024] AS ids FROM d)')}"
ORACLES["decode_ids"] = f"SELECT doc_id, {prefixed('text')} AS text FROM documents"
ORACLES["causal_labels"] = (
    f"WITH {BYTE_BLOCKS} SELECT doc_id, block_no, {digest('list_resize(part, 1024, -100)')} AS digest FROM b"
)
ORACLES["shifted_labels"] = (
    f"WITH {DOC_EOS} {id_summary('doc_id', f'(SELECT doc_id, list_append(ids[2:1024], {EOS}) AS ids FROM d)')}"
)
ORACLES["whole_packed_documents"] = f"WITH {DOC_EOS} {id_summary('doc_id', 'd')}"
ORACLES["budget_batches"] = f"WITH {DOC_EOS} SELECT *, true AS within FROM ({id_summary('doc_id', 'd')})"
SHARD = f"({hashed('doc_id')} // {(1 << 60) // 4 + 1})::INT"
ORACLES["streamed_packing"] = (
    f"WITH {DOC_EOS}, o AS (SELECT {SHARD} AS shard, ids, sum(len(ids)) OVER (PARTITION BY {SHARD} ORDER BY doc_id) - len(ids) AS o FROM d), "
    "t AS (SELECT shard, o + i AS place, id FROM (SELECT shard, o, unnest(ids) AS id, unnest(range(0, len(ids))) AS i FROM o)) "
    "SELECT shard, (place // 1024)::BIGINT AS block_no, count(*)::INT AS n_ids, md5(string_agg(id::VARCHAR, ',' ORDER BY place)) AS digest FROM t GROUP BY 1, 2"
)
ORACLES["packed_rows"] = (
    f"WITH {DOC_EOS}, o AS (SELECT ids, sum(len(ids)) OVER (ORDER BY {hashed('doc_id')}, doc_id) - len(ids) AS o FROM d), "
    "t AS (SELECT o + i AS place, id FROM (SELECT o, unnest(ids) AS id, unnest(range(0, len(ids))) AS i FROM o)) "
    "SELECT (place // 1024)::BIGINT AS block_no, count(*)::INT AS n_ids, md5(string_agg(id::VARCHAR, ',' ORDER BY place)) AS digest FROM t GROUP BY 1"
)
ORACLES["padded_batches"] = (
    f"WITH b AS (SELECT doc_id, row_index // 16 AS batch_id, ids[1:1024] AS part FROM ({SHUFFLED}) JOIN "
    f"(SELECT doc_id, {byte_encoded('text')} AS ids FROM documents) USING (doc_id)), "
    f"m AS (SELECT *, max(len(part)) OVER (PARTITION BY batch_id) AS w FROM b) {block_summary('doc_id, batch_id', 'm', 'w')}"
)

# Dataset builders

TURN_LINE = "CASE role WHEN 'user' THEN 'User: ' || text WHEN 'assistant' THEN 'Assistant: ' || text END"
ORACLES["conversation_texts"] = (
    f"SELECT conv_id, {strip(f'coalesce(string_agg({TURN_LINE}, chr(10) ORDER BY turn), {chr(39) * 2})')} AS text FROM conversations GROUP BY 1"
)
LABELS = "['User: ', 'Assistant: ', NULL]"


def nested_text(lines: str) -> str:
    rendered = f"list_transform({lines}, lambda x, i: {LABELS}[(i - 1) % 3 + 1] || x)"
    return strip(f"array_to_string(list_filter({rendered}, lambda x: x IS NOT NULL), chr(10))")


SPLIT = "string_split(text, chr(10))"
ORACLES["nested_conversation_texts"] = f"SELECT doc_id AS id, {nested_text(SPLIT)} AS text FROM documents"
ARENA = (
    f"arena AS (SELECT id, {side('winner', 'id', nested_text(SPLIT), nested_text(f'list_reverse({SPLIT})'))} AS text FROM "
    f"(SELECT doc_id AS id, text, {pick('doc_id % 4', WINNERS)} AS winner FROM documents WHERE lang = 'en'))"
)


def chat(source: str, ids: str) -> str:
    return f"chat AS (SELECT id, text, len({ids})::INT AS length FROM {source} WHERE len({ids}) > 20 AND len({ids}) <= 1024 AND length(text) > 0)"


ORACLES["chat_texts"] = f"WITH {ARENA}, {chat('arena', encoded('text'))} SELECT id, text, length FROM chat"
ORACLES["trainer_text"] = f"WITH {ARENA}, {chat('arena', byte_encoded('text'))} SELECT text FROM chat"
ORACLES["chat_texts_of_turns"] = (
    "WITH c AS (SELECT max(conv_id) + 1 AS c FROM conversations), "
    f"won AS (SELECT id, {side('winner', 'id', 'id % c', '(id * 7 + 1) % c')} AS conv_id FROM "
    f"(SELECT doc_id AS id, {pick('doc_id % 4', WINNERS)} AS winner, c FROM documents, c WHERE lang = 'en')), "
    f"r AS (SELECT id, {strip(f'string_agg({TURN_LINE}, chr(10) ORDER BY turn)')} AS text FROM won JOIN conversations USING (conv_id) "
    f"WHERE role IN ('user', 'assistant') GROUP BY 1), {chat('r', encoded('text'))} SELECT id, text, length FROM chat"
)
ORACLES["chat_texts_split"] = (
    f"WITH {ARENA}, {chat('arena', encoded('text'))} SELECT id, length, CASE WHEN r <= ceil(0.1::DOUBLE * n) THEN 'test' ELSE 'train' END AS split "
    f"FROM (SELECT id, length, row_number() OVER (ORDER BY {hashed('id')}, id) AS r, count(*) OVER () AS n FROM chat)"
)


def instruct(i: str, r: str) -> str:
    return f"'Instruction: ' || {i} || chr(10) || 'Response: ' || {r}"


ORACLES["instruction_texts"] = f"WITH {INSTRUCTIONS} SELECT id, {instruct('instruction', 'input')} AS text FROM ins"


def pair_summary(keys: str, source: str) -> str:
    cols = []
    for s in ("chosen", "rejected"):
        cols.append(f"len({s})::INT AS n_{s}, {digest(s)} AS ids_{s}, {digest(ones(f'len({s})'))} AS mask_{s}")
    ids = ", ".join(f"({encoded('(' + instruct('instruction', s) + ')')})[1:1024] AS {s}" for s in ("chosen", "rejected"))
    return f"SELECT {keys}, {', '.join(cols)} FROM (SELECT {keys}, {ids} FROM {source})"


ORACLES["preference_tokens"] = pair_summary("id", f"(SELECT * FROM ({BEST}) WHERE n >= 2)")
ORACLES["preference_tokens_of_turns"] = f"WITH {PAIRS} {pair_summary('id', 'pairs')}"
SPLIT_BEST = (
    "SELECT *, CASE WHEN r <= ceil(0.1::DOUBLE * least(total, 150)) THEN 'test' ELSE 'train' END AS split FROM "
    f"(SELECT *, row_number() OVER (ORDER BY {hashed('id')}, id) AS r, count(*) OVER () AS total FROM ({BEST})) WHERE r <= 150 AND n >= 2"
)
ORACLES["preference_split"] = pair_summary("id, split", f"({SPLIT_BEST})")
CLIPPED = "left(CASE WHEN input <> '' THEN instruction || chr(10) || input ELSE instruction END, 1500)"
ORACLES["prompt_texts"] = f"WITH {INSTRUCTIONS} SELECT id, {strip(CLIPPED)} AS prompt FROM ins"
# A token is a byte here: whole characters that fit in 350 bytes, then one
# replacement character if the cut falls inside the next one.
ORACLES["prompts"] = (
    f"WITH {INSTRUCTIONS}, t AS (SELECT id, {prefixed('p')} AS p FROM (SELECT id, {CLIPPED} AS p FROM ins)), "
    "c AS (SELECT id, p, i, octet_length(encode(left(p, i))) AS o FROM (SELECT id, p, unnest(range(0, least(length(p), 350) + 1)) AS i FROM t)), "
    "f AS (SELECT id, any_value(p) AS p, max(i) AS i, max(o) AS o FROM c WHERE o <= 350 GROUP BY 1) "
    f"SELECT id, {strip('left(p, i) || CASE WHEN o < 350 AND i < length(p) THEN chr(65533) ELSE ' + chr(39) * 2 + ' END')} AS prompt FROM f"
)
TOKEN_BYTES = "[" + ",".join(str(len(t)) for t in TOKENIZER.tokens) + "]"
# The first 350 tokens end after a known number of bytes.
ORACLES["sampled_prompts"] = (
    f"WITH {INSTRUCTIONS}, s AS (SELECT id, {CLIPPED} AS p FROM (SELECT *, row_number() OVER (ORDER BY {hashed('id')}, id) AS r FROM ins) WHERE r <= 120), "
    f"t AS (SELECT id, {prefixed('p')} AS p, list_sum(list_transform(({encoded('p')})[1:350], lambda x: {TOKEN_BYTES}[x + 1])) AS cut FROM s), "
    "c AS (SELECT id, p, cut, i, octet_length(encode(left(p, i))) AS o FROM (SELECT *, unnest(range(0, length(p) + 1)) AS i FROM t)), "
    "f AS (SELECT id, any_value(p) AS p, any_value(cut) AS cut, max(i) AS i, max(o) AS o FROM c WHERE o <= cut GROUP BY 1) "
    f"SELECT id, {strip('left(p, i) || CASE WHEN o < cut THEN chr(65533) ELSE ' + chr(39) * 2 + ' END')} AS prompt FROM f"
)
ORACLES["generation_prompts"] = (
    "SELECT conv_id, turn, 'User: ' || text || chr(10) || 'Assistant:' AS chat_prompt, "
    "'Instruction: ' || text || chr(10) || 'Response:' AS instruction_prompt FROM conversations"
)
ORACLES["training_blocks"] = (
    f"WITH {CORPUS}, kept AS (SELECT source, source || ':' || id AS doc_id, text FROM "
    "(SELECT *, row_number() OVER (PARTITION BY source ORDER BY id) AS r, count(*) OVER (PARTITION BY source) AS n FROM corpus) "
    "WHERE source <> 'web' OR r <= round_even(0.1::DOUBLE * n, 0)), "
    f"d AS (SELECT source, doc_id, list_append({encoded('text')}, {EOS}) AS ids FROM kept), "
    f"b AS ({block_rows('d', 'source, doc_id')}) {block_summary('source, doc_id, block_no', 'b')}"
)

ORACLES["stored_training_blocks"] = (
    ORACLES["training_blocks"].rsplit(", b AS (", 1)[0]
    + " SELECT source, count(*) AS documents, sum(ceil(len(ids) / 1024.0))::BIGINT AS n_blocks, sum(len(ids))::BIGINT AS n_tokens, "
    "round(1 - sum(len(ids)) / (sum(ceil(len(ids) / 1024.0)) * 1024), 8) AS pad_share, true AS sorted_in_files, true AS files_apart FROM d GROUP BY 1"
)

# Evaluation

ORACLES["stage_counts"] = (
    f"SELECT 'documents' AS stage, count(*) AS rows, 0::BIGINT AS tokens FROM documents UNION ALL "
    f"SELECT 'blocks', sum(ceil({N_BYTES} / 1024.0))::BIGINT, sum({N_BYTES})::BIGINT FROM documents"
)
ORACLES["pair_accuracy"] = (
    f"WITH {PAIRS}, s AS (SELECT length(chosen) AS g, length(rejected) AS b FROM pairs), "
    "a AS (SELECT count(*) FILTER (WHERE g > b) AS correct, count(*) AS total, avg(g - b) AS mean_margin FROM s) "
    "SELECT correct, total, mean_margin, correct / total AS accuracy, "
    "CASE WHEN correct / total >= 0.8 THEN 'excellent' WHEN correct / total >= 0.6 THEN 'good' ELSE 'needs work' END AS verdict FROM a"
)
ORACLES["generation_time"] = (
    f"WITH {PAIRS} SELECT model, count(*) AS n, round(sum(length(output)) / 100, 4) AS total_seconds, round(avg(length(output)) / 100, 8) AS avg_seconds FROM gen GROUP BY 1"
)
ORACLES["group_advantage"] = (
    "SELECT conv_id AS prompt_id, turn AS sample_id, r AS reward, round((r - avg(r) OVER w) / (coalesce(stddev_samp(r) OVER w, 0) + 0.0001), 5) AS advantage "
    "FROM (SELECT conv_id, turn, ((length(text) % 10) / 2.0)::DOUBLE AS r FROM conversations WHERE role = 'assistant') WINDOW w AS (PARTITION BY conv_id)"
)
ORACLES["scored_rows"] = (
    f"SELECT conv_id, turn, ({total(f'({encoded("(" + instruct("role", "text") + ")")})[1:1024]')} % 1000) / 10.0::DOUBLE AS score FROM conversations"
)
ORACLES["extracted_responses"] = f"WITH {PAIRS} SELECT prompt_id, model, {LAST_ANSWER} AS response FROM gen"
ORACLES["dropped_prompts"] = f"WITH {PAIRS} SELECT prompt_id, model, {strip('substr(output, length(prompt) + 1)')} AS response FROM gen"
ORACLES["generated_ids"] = (
    f"WITH {PAIRS}, d AS (SELECT prompt_id, model, ({byte_encoded('output')})[len({byte_encoded('prompt')}) + 1 :] AS ids FROM gen) {id_summary('prompt_id, model', 'd')}"
)
ORACLES["prompt_suite_report"] = (
    f"WITH {PAIRS}, g AS (SELECT prompt_id, count(*) AS n, sum(length(output)) AS s FROM gen GROUP BY 1) "
    "SELECT item_id % 7 AS \"group\", count(*) AS prompts, coalesce(sum(n), 0)::BIGINT AS answers, round(sum(s) / 100, 4) AS total_seconds, "
    "round(sum(s) / 100 / sum(n), 8) AS avg_seconds FROM benchmark LEFT JOIN g ON prompt_id = item_id GROUP BY 1"
)

# Runs

LOG = (
    "log AS (SELECT user_id % 10 AS run, event_id % 4 AS rank, CASE WHEN event_id % 23 <> 6 THEN date_trunc('milliseconds', ts) END AS ts, event_id + 1 AS step, "
    "CASE WHEN event_id % 997 = 5 THEN 'nan'::DOUBLE WHEN event_id % 11 <> 7 AND event_id % 19 <> 4 THEN round(value, 4) END AS train_loss, "
    "CASE WHEN event_type <> 'error' THEN (event_id % 997) / 1e7::DOUBLE END AS lr, "
    "(event_id % 5000) / 100.0::DOUBLE AS runtime, (user_id % 300) / 4.0::DOUBLE AS samples_per_second, "
    "CASE WHEN event_id % 3 = 0 THEN (event_id % 400) / 16.0::DOUBLE END AS steps_per_second FROM events WHERE event_id % 17 <> 3)"
)


def named_nan(column: str) -> str:
    return f"coalesce(isnan({column}), false) AS is_nan, CASE WHEN NOT isnan({column}) THEN round({column}, 8) END AS {column}"


ORACLES["parsed_log"] = f"WITH {LOG} SELECT * REPLACE (CASE WHEN NOT isnan(train_loss) THEN train_loss END AS train_loss), coalesce(isnan(train_loss), false) AS is_nan FROM log"
ORACLES["log_report"] = (
    "SELECT user_id % 10 AS run, count(*) AS lines, count(*) FILTER (WHERE event_id % 17 <> 3) AS with_step, "
    "count(*) FILTER (WHERE event_id % 23 = 6 OR (event_id % 17 <> 3 AND event_id % 997 <> 5 AND event_id % 11 <> 7 AND event_id % 19 = 4)) AS damaged, "
    "count(*) FILTER (WHERE event_id % 17 <> 3 AND event_id % 997 = 5) AS not_finite FROM events GROUP BY 1"
)


def clock(x: str) -> str:
    s = f"floor({x})::BIGINT"
    return f"printf('%02d:%02d:%02d', {s} // 3600, {s} % 3600 // 60, {s} % 60)"


ORACLES["run_progress"] = (
    f"WITH {LOG}, e AS (SELECT run, step, ts, step / 200000 AS progress, "
    "(epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run)) / 1e6::DOUBLE AS el FROM log) "
    f"SELECT run, step, ts, progress, {clock('el')} AS elapsed, {clock('el / progress - el')} AS remaining FROM e"
)
ORACLES["streamed_progress"] = (
    f"WITH {LOG}, e AS (SELECT run::VARCHAR AS run, first(step ORDER BY ts DESC, step DESC) AS step, count(*) AS lines, "
    "(max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6::DOUBLE AS el FROM log WHERE ts IS NOT NULL AND step IS NOT NULL GROUP BY 1), "
    "p AS (SELECT *, step / 200000 AS progress FROM e) "
    f"SELECT run, step, lines, progress, {clock('el')} AS elapsed, {clock('el / progress - el')} AS remaining FROM p"
)
ORACLES["main_process_log"] = f"WITH {LOG} SELECT run, step, CASE WHEN isnan(train_loss) THEN -1 ELSE train_loss END AS train_loss FROM log WHERE rank = 0"
ORACLES["loss_per_bucket"] = (
    f"WITH {LOG}, b AS (SELECT run, step // 50 AS bucket, avg(train_loss) AS mean_loss, count(train_loss) AS lines FROM log GROUP BY 1, 2) "
    f"SELECT run, bucket, {named_nan('mean_loss')}, lines FROM b"
)
CHECKPOINTS = "SELECT user_id % 10 AS run, event_id + 1 AS step, 'out/run-' || user_id % 10 || '/checkpoint-' || (event_id + 1) AS path, value AS loss FROM events"
ORACLES["latest_checkpoint"] = f"SELECT run, arg_max(path, step) AS latest_path FROM ({CHECKPOINTS}) GROUP BY 1"
ORACLES["best_checkpoint"] = f"SELECT run, first(path ORDER BY loss, step) AS best_path FROM ({CHECKPOINTS}) WHERE loss IS NOT NULL GROUP BY 1"
ORACLES["newest_checkpoints"] = (
    f"SELECT run, path FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS r FROM ({CHECKPOINTS})) WHERE r <= 3"
)
# A stream only closes the windows that end before the watermark.
OPEN = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM log WHERE rank = 0 AND train_loss IS NOT NULL)"
CLOSED = (
    f"{LOG}, w AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start FROM log WHERE rank = 0 AND train_loss IS NOT NULL AND ts IS NOT NULL), "
    f"closed AS (SELECT * FROM w WHERE window_start + INTERVAL 1 HOUR <= {OPEN})"
)
ORACLES["streamed_loss"] = (
    f"WITH {CLOSED}, s AS (SELECT window_start, run, avg(train_loss) AS mean_loss, max(step) AS latest_step, "
    "min(step // 50) AS first_bucket, max(step // 50) AS last_bucket, count(*) AS lines FROM closed GROUP BY 1, 2) "
    f"SELECT window_start, run, {named_nan('mean_loss')}, latest_step, first_bucket, last_bucket, lines FROM s"
)
ORACLES["streamed_bucket_means"] = (
    f"WITH {CLOSED}, s AS (SELECT run, step // 50 AS bucket, avg(train_loss) AS mean_loss, count(*) AS lines FROM closed GROUP BY 1, 2) "
    f"SELECT run, bucket, {named_nan('mean_loss')}, lines FROM s"
)

ORACLES["blocks_per_language"] = (
    f"WITH t AS (SELECT lang, {strip('text')} AS text FROM documents), n AS (SELECT lang, {N_BYTES} AS n FROM t) "
    "SELECT lang, sum(ceil(n / 1024.0))::BIGINT AS n_blocks, sum(n)::BIGINT AS n_tokens, "
    "1 - sum(n) / (sum(ceil(n / 1024.0)) * 1024) AS pad_share FROM n GROUP BY 1"
)
