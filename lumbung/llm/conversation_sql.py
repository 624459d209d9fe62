"""Expected results of the queries over conversations, as SQL."""

from __future__ import annotations

WORDLESS = r"[\x20\x09-\x0D]"
WORDY = r"[^\x20\x09-\x0D]"


def checksum(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit: a new byte joins every eight steps. The number is its reversed polynomial."""
    byte = f"CASE WHEN i % 8 = 0 THEN xor(c, ascii(({text})[i // 8 + 1])::BIGINT) ELSE c END"
    step = f"xor(({byte}) >> 1, (({byte}) & 1) * 3988292384)"
    start = "4294967295::BIGINT"
    return f"xor(list_reduce(range(8 * length({text})), lambda c, i: {step}, {start}), {start})"


def edited(state: str, letter: str, cost: str, line: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'o': {state}.o || {line}}}"


NEVER = "{'c': 1000000000::BIGINT, 'a': '', 'o': ''}"
INSERTED_USER, INSERTED_ASSISTANT = r"chr(10) || 'user:'", r"chr(10) || 'assistant:'"
KEPT = "chr(10) || x.role || ':' || x.text"
MAY_STAY = "x.fault IN ('', 'truncated')"
STAYS = "(x.fault = 'truncated')::INTEGER"


def kept(state: str, initial: str) -> str:
    return f"CASE WHEN {MAY_STAY} AND x.initial = '{initial}' THEN {edited(state, 'K', STAYS, KEPT)} ELSE {NEVER} END"


def reroled(state: str, role: str) -> str:
    line = f"chr(10) || '{role}:' || x.text"
    return f"CASE WHEN {MAY_STAY} THEN {edited(state, 'R', f'2 + {STAYS}', line)} ELSE {NEVER} END"


def deleted(state: str) -> str:
    return edited(state, "D", "3", "''")


def at_step(user: str, assistant: str, row: str) -> str:
    """Before a row come two steps that insert a user and an assistant turn, where that is cheaper."""
    return f"CASE x.step WHEN 'user' THEN {user} WHEN 'assistant' THEN {assistant} ELSE {row} END"


def before_user(edit, *args: str) -> str:
    return ", ".join(edit(state, *args) for state in ("s.n", "s.s", "s.e"))


TO_USER = "least(s.u, " + ", ".join(edited(f"s.{k}", "I", "2", INSERTED_USER) for k in "nse") + ")"
TO_ASSISTANT = f"least(s.e, {edited('s.u', 'I', '2', INSERTED_ASSISTANT)})"
STEP = f"""{{
    'n': {at_step('s.n', 's.n', deleted('s.n'))},
    's': {at_step('s.s', 's.s', f"least({deleted('s.s')}, {kept('s.n', 's')})")},
    'u': {at_step(TO_USER, 's.u', f"least({deleted('s.u')}, {before_user(kept, 'u')}, {before_user(reroled, 'user')})")},
    'e': {at_step('s.e', TO_ASSISTANT, f"least({deleted('s.e')}, {kept('s.u', 'a')}, {reroled('s.u', 'assistant')})")}
}}"""
INSERTIONS = "[{'step': 'user', 'initial': '', 'fault': '', 'role': '', 'text': ''}, {'step': 'assistant', 'initial': '', 'fault': '', 'role': '', 'text': ''}]"

REPAIR = rf"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
), kinds AS (
    SELECT *, {checksum("key")} % 20 AS kind FROM given
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM kinds WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role COLLATE C, md5(text), copy) AS place FROM damaged
), marked AS (
    SELECT *, substr(role, 1, 1) AS initial,
        CASE WHEN NOT regexp_matches(text, '{WORDY}') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
            WHEN regexp_extract(text, '({WORDY}){WORDLESS}*\z', 1) NOT IN ('.', '!', '?') THEN 'truncated'
            ELSE '' END AS fault,
        lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS initial_before
    FROM placed
), per_conv AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (initial_before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
        list({{'step': 'row', 'initial': initial, 'fault': fault, 'role': role, 'text': text}} ORDER BY place) AS turns
    FROM marked GROUP BY conv_id
), searched AS (
    SELECT *, list_reduce(
        list_concat(flatten(list_transform(turns, lambda t: list_concat({INSERTIONS}, [t]))), {INSERTIONS}),
        lambda s, x: {STEP},
        {{'n': {{'c': 0::BIGINT, 'a': '', 'o': ''}}, 's': {NEVER}, 'u': {NEVER}, 'e': {NEVER}}}
    ) AS s FROM per_conv
), answered AS (SELECT *, least(s.n, s.e) AS best FROM searched)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
    coalesce(best.a, '') AS audit, sha256(coalesce(best.o[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN answered a ON i.conv_id IS NOT DISTINCT FROM a.conv_id
"""

TRIE = rf"""
WITH given AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT conv_id, md5(role) || md5(text) AS id, length(text) AS chars,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role COLLATE C, md5(text)) AS n
    FROM given
), convs AS (
    SELECT conv_id, {checksum("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM placed)
), rebuilt AS (
    SELECT c.conv_id, 0 AS source, p.n, p.id, p.chars
    FROM convs c JOIN placed p ON p.conv_id = c.conv_id - c.conv_id % 100 AND p.n <= c.h
    UNION ALL
    SELECT c.conv_id, 1, p.n, p.id, p.chars FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.n > c.h
), paths AS (
    SELECT conv_id, chars, row_number() OVER w AS depth, string_agg(id, '') OVER w AS path
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY source, n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM convs
), nodes AS (
    SELECT path, any_value(depth) AS depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs
    FROM paths GROUP BY path
), whole AS (
    SELECT conv_id, max_by(path, depth) AS path FROM paths GROUP BY conv_id
), ends AS (
    SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM whole GROUP BY path
), children AS (
    SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), below AS (
    SELECT left(n.path, 64 * a) AS path, sum((n_convs - 1) * chars)::BIGINT AS saved_tokens,
        count(*) FILTER (c.path IS NULL) AS n_leaves
    FROM nodes n LEFT JOIN children c ON c.path = n.path, unnest(range(0, n.depth + 1)) AS r(a) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
    sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN children c ON c.path = n.path LEFT JOIN ends e ON e.path = n.path
    LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 64 * (n.depth - 1))
"""
