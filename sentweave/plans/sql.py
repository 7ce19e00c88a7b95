"""Pieces of DuckDB SQL that several queries' SQL shares."""

from sentweave.functions import english, text, urls
from sentweave.operators import html


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def values(rows: list[tuple], names: str) -> str:
    """A table of literals, for queries over inline rows."""
    cell = lambda v: "NULL" if v is None else q(v) if isinstance(v, str) else str(v)
    return f"(VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS v({names})"


def attribute(tag: str, name: str) -> str:
    found = f"regexp_extract({tag}, {q(f'(?is)\\s{name}\\s*=\\s*(\"[^\"]*\"|' + chr(39) + '[^' + chr(39) + ']*' + chr(39) + '|[^\\s>\"' + chr(39) + ']+)')}, 1)"
    return f"CASE WHEN {found} <> '' THEN regexp_replace(regexp_replace({found}, {q('^[\"' + chr(39) + ']')}, ''), {q('[\"' + chr(39) + ']$')}, '') END"


TOKENS = f"""t0 AS (SELECT page_id, unnest(regexp_extract_all(html, {q(html.TOKEN)})) AS token, unnest(range(len(regexp_extract_all(html, {q(html.TOKEN)})))) AS pos FROM pages WHERE strlen(html) <= 5242880),
t1 AS (SELECT page_id, CAST(pos AS INT) AS pos, token, CASE WHEN starts_with(token, '<!--') THEN 'C' WHEN regexp_matches(token, '^<[!?]') THEN 'D' WHEN regexp_matches(token, '(?i)^<(script|style)\\b') THEN 'X' WHEN starts_with(token, '</') THEN 'E' WHEN regexp_matches(token, '^<[a-zA-Z]') THEN 'S' ELSE 'T' END AS kind FROM t0),
tokens AS (SELECT page_id, pos, kind, CASE WHEN kind IN ('S', 'E', 'X') THEN lower(regexp_extract(token, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) END AS tag, token,
 CAST(coalesce(sum(strlen(token)) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_off, CAST(strlen(token) AS BIGINT) AS byte_len FROM t1)"""


def _names(tags: list[str]) -> str:
    return "(" + ", ".join(map(q, tags)) + ")"


def _mode(tags: list[str]) -> str:
    return f"coalesce(last_value(CASE WHEN kind = 'S' AND tag IN {_names(tags)} THEN true WHEN kind = 'E' AND tag IN {_names(tags)} THEN false END IGNORE NULLS) OVER w, false)"


FLAGGED = f"""{TOKENS},
firsts AS (SELECT page_id, min(pos) AS p FROM tokens WHERE kind = 'S' AND tag = 'title' GROUP BY page_id),
flagged AS (SELECT t.*, CAST(sum(CASE WHEN kind IN ('S', 'E') AND tag IN {_names(html.DELIMITERS)} THEN 1 ELSE 0 END) OVER w AS INT) AS seg_no,
 coalesce(last_value(CASE WHEN pos = f.p THEN true WHEN kind = 'E' THEN false END IGNORE NULLS) OVER w, false) AS in_title,
 coalesce(last_value(CASE WHEN regexp_matches(tag, '^h[1-6]$') AND kind = 'S' THEN CAST(tag[2:2] AS INT) WHEN regexp_matches(tag, '^h[1-6]$') AND kind = 'E' THEN 0 END IGNORE NULLS) OVER w, 0) AS heading,
 {_mode(html.LISTS)} AS list, {_mode(['table'])} AS "table", {_mode(html.PREFORMATTED)} AS pre, {_mode(['a'])} AS link,
 coalesce(last_value(CASE WHEN kind = 'S' THEN coalesce({attribute('token', 'myblocktype')}, 'unknown_block') END IGNORE NULLS) OVER w, 'unknown_block') AS block_type
 FROM tokens t LEFT JOIN firsts f USING (page_id) WINDOW w AS (PARTITION BY t.page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

SEGMENTS = f"""{FLAGGED},
segments AS (SELECT page_id, seg_no, string_agg(token, '' ORDER BY pos) AS text, min(byte_off) AS "offset", max(byte_off + byte_len) - min(byte_off) AS length,
 arg_max(heading, pos) AS heading, arg_max(list, pos) AS list, arg_max("table", pos) AS "table", arg_max(pre, pos) AS pre, arg_max(block_type, pos) AS block_type
 FROM flagged WHERE kind = 'T' AND NOT in_title GROUP BY page_id, seg_no)"""


def _entity_map() -> str:
    return "MAP {" + ", ".join(f"{q('&' + name)}: {q(char)}" for name, char in text.ENTITIES.items()) + "}"


def decode_entities(c: str) -> str:
    """Character references, each decoded by itself: a list of pieces, a map of names, and ``chr`` of numbers."""
    number = "CASE WHEN regexp_matches(p, '^&#[xX]') THEN CAST('0x' || regexp_extract(p, '^&#[xX]([0-9a-fA-F]+)', 1) AS BIGINT) ELSE CAST(regexp_extract(p, '^&#([0-9]+)', 1) AS BIGINT) END"
    one = f"CASE WHEN regexp_matches(p, '^&#([0-9]|[xX][0-9a-fA-F])') THEN CASE WHEN {number} BETWEEN 1 AND 55295 OR {number} BETWEEN 57344 AND 1114111 THEN chr(CAST({number} AS INT)) ELSE chr(65533) END ELSE coalesce({_entity_map()}[p], p) END"
    pieces = f"regexp_extract_all(regexp_replace({c}, '&(#160|#[xX][aA]0|nbsp);', ' ', 'g'), {q(text.REFERENCE + '|[^&]+|&')})"
    return f"CASE WHEN contains({c}, '&') THEN array_to_string(list_transform({pieces}, lambda p: CASE WHEN starts_with(p, '&') THEN {one} ELSE p END), '') ELSE {c} END"


def clean_segment(c: str) -> str:
    c = f"regexp_replace({decode_entities(c)}, '[\\x00-\\x09\\x0b-\\x1f\\x7f-\\x{{9f}}]', '', 'g')"
    return f"regexp_replace(regexp_replace({c}, '^[\\x{{3000}}\\s]+', ''), '[\\x{{3000}}\\s]+$', '')"


def ends_sentence(w: str, n: str, a: str) -> str:
    """Whether a sentence ends after word ``w``: its code of six letters, worked out here, is one that ends a sentence."""
    before, mark, behind = (f"regexp_extract({w}, {q(english.MARKED)}, {i})" for i in (1, 2, 3))
    one = lambda x, words: f"{x} IN ({', '.join(map(q, words))})"
    last = f"({n} = '' AND {a} = '')"
    follower = lambda x: f"CASE WHEN {last} THEN 'N' " + " ".join(f"WHEN regexp_matches({x}, {q(p)}) THEN '{k}'" for k, p in english.FOLLOWERS.items()) + " ELSE 'o' END"
    kind = f"CASE WHEN {behind} <> '' AND {one(behind, english.RIGHT_PARENS + english.RIGHT_QUOTES)} THEN 'c' WHEN {behind} <> '' THEN 'x' WHEN {mark} = '.' THEN 'p' ELSE 'l' END"
    titled = f"({one(before + ' || ' + q('.'), english.HONORIFICS)} OR ({before} IN ('p.m', 'a.m') AND {one(f'left({n}, 3)', english.TIME_ZONES)}) OR regexp_matches({before}, {q('^[' + chr(39) + '"`]')}))"
    left = f"CASE WHEN {titled} THEN 'n' WHEN {one(before, english.TERMINALS)} THEN 't' WHEN regexp_matches({before}, '^([A-Z]\\.)*[A-Z]$') THEN 'i' ELSE 'o' END"
    quoted = f"CASE WHEN regexp_matches({before}, {q('[' + chr(39) + '"]$')}) THEN 'q' ELSE '-' END"
    code = f"({kind}) || ({follower(n)}) || ({follower(a)}) || ({left}) || ({quoted}) || CASE WHEN {before} = '' THEN 'e' ELSE '-' END"
    return f"CASE WHEN regexp_matches({w}, '[.?!]') THEN regexp_matches({code}, {q(english.END)}) ELSE false END"


def split_english(source: str, key: str, column: str) -> str:
    """CTEs that end with ``cut (key, k, sentence)``: the sentences of ``column`` of ``source`` by unique ``key``."""
    return f"""w0 AS (SELECT {key}, unnest(regexp_extract_all({column}, '[^\\x20\\x09-\\x0D]+')) AS w, unnest(range(len(regexp_extract_all({column}, '[^\\x20\\x09-\\x0D]+')))) AS i FROM {source}),
w1 AS (SELECT *, coalesce(lead(w, 1) OVER o, '') AS n, coalesce(lead(w, 2) OVER o, '') AS a FROM w0 WINDOW o AS (PARTITION BY {key} ORDER BY i)),
w2 AS (SELECT *, {ends_sentence('w', 'n', 'a')} AS e FROM w1),
w3 AS (SELECT *, coalesce(sum(CASE WHEN e THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM w2),
cut AS (SELECT {key}, CAST(k AS INT) AS k, string_agg(w, ' ' ORDER BY i) AS sentence FROM w3 GROUP BY {key}, k)"""


_PIECE = text.REFERENCE + "|[ \\n]+|[\\x00-\\x09\\x0b-\\x1f\\x7f-\\x{9f}]+|[^& \\n\\x00-\\x1f\\x7f-\\x{9f}]+|&"

#: Byte spans of the words of each segment, numbered from 0: pieces of text tokens between blanks, over tags where no blank stands.
WORDS = f"""p0 AS (SELECT page_id, seg_no, pos, byte_off, unnest(regexp_extract_all(token, {q(_PIECE)})) AS piece, unnest(range(len(regexp_extract_all(token, {q(_PIECE)})))) AS j FROM flagged WHERE kind = 'T' AND NOT in_title),
p1 AS (SELECT page_id, seg_no, pos, j, strlen(piece) AS size, byte_off + coalesce(sum(strlen(piece)) OVER (PARTITION BY page_id, pos ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
 regexp_replace({decode_entities('piece')}, '[\\x00-\\x09\\x0b-\\x1f\\x7f-\\x{{9f}}]', '', 'g') AS d FROM p0),
p2 AS (SELECT *, regexp_matches(d, '^[ \\n]+$') AS blank FROM p1 WHERE d <> ''),
p3 AS (SELECT *, CASE WHEN NOT blank AND coalesce(lag(blank) OVER (PARTITION BY page_id, seg_no ORDER BY pos, j), true) THEN 1 ELSE 0 END AS first FROM p2),
p4 AS (SELECT *, sum(first) OVER (PARTITION BY page_id, seg_no ORDER BY pos, j) - 1 AS wn FROM p3),
word_spans AS (SELECT page_id, seg_no, wn, min(off) AS a, max(off + size) AS b FROM p4 WHERE NOT blank GROUP BY page_id, seg_no, wn)"""

JAPANESE = "[\\p{Hiragana}\\p{Katakana}ー\\p{Han}\\p{P}]"


def share(found: str, of: str) -> str:
    """A share to five decimals by whole numbers; null of nothing."""
    return f"((200000 * {found} + {of}) // nullif(2 * {of}, 0)) / CAST(100000 AS DOUBLE)"


def japanese_score(c: str, pattern: str = JAPANESE) -> str:
    return f"CASE WHEN length({c}) = 0 THEN 0.0 ELSE {share(f'len(regexp_extract_all({c}, {q(pattern)}))', f'length({c})')} END"


def clean_path(path: str) -> str:
    """No empty steps and no ``.``; ``..`` takes the step before it back; a closing slash stays."""
    steps = f"list_filter(string_split({path}, '/'), lambda s: s NOT IN ('', '.'))"
    done = f"coalesce(list_reduce(list_prepend('', {steps}), lambda done, s: CASE WHEN s = '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || s END), '')"
    return f"{done} || CASE WHEN {done} = '' OR regexp_matches({path}, '/[.]{{0,2}}$') THEN '/' ELSE '' END"


def canonical(url: str) -> str:
    host = f"regexp_extract({url}, '^(?i)(https?)://([^/?#]+)', 0)"
    rest = f"regexp_replace({url}[length({host}) + 1:], '#.*$', '')"
    path, query = f"regexp_extract({rest}, '^([^?]*)', 1)", f"regexp_extract({rest}, '(\\?.*)$', 1)"
    return f"CASE WHEN {host} <> '' THEN lower({host}) || CASE WHEN {path} = '' THEN '/' ELSE {clean_path(path)} END || {query} END"


ANCHORS = f"""a0 AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*>[^<]*</a\\s*>')) AS a, unnest(range(len(regexp_extract_all(html, '(?is)<a\\b[^>]*>[^<]*</a\\s*>')))) AS pos FROM pages),
a1 AS (SELECT page_id, url, CAST(pos AS INT) AS pos, {attribute("regexp_extract(a, '(?is)^(<a\\b[^>]*>)', 1)", "href")} AS href, trim(regexp_replace({decode_entities("regexp_replace(a, '</?[a-zA-Z][^>]*>', '', 'g')")}, '\\s+', ' ', 'g')) AS anchor FROM a0),
a2 AS (SELECT *, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^(https?://[^/?#]*)', 1) || href ELSE href END AS full_url FROM a1
 WHERE href IS NOT NULL AND href <> '' AND NOT regexp_matches(href, '^mail|javascript|#|\\.(jpe?g|gif|png)$') AND anchor <> ''),
anchors AS (SELECT page_id AS from_id, url AS from_url, pos, href, {canonical('full_url')} AS to_url, anchor FROM a2)"""

KNOWN = f"""known AS (SELECT regexp_replace({canonical('url')}, '^https?://', '') AS k, min(CAST(page_id AS VARCHAR)) AS id FROM pages GROUP BY 1),
named AS (SELECT a.*, coalesce(k.id, {q(urls.UNKNOWN_ID)}) AS to_id FROM anchors a LEFT JOIN known k ON regexp_replace(a.to_url, '^https?://', '') = k.k)"""

