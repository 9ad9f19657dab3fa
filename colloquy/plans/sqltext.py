"""Pieces of DuckDB text that mirror the column expressions, for the oracle queries."""

from __future__ import annotations

from colloquy.functions import rules as R
from colloquy.functions import text as T


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim(c: str) -> str:
    return f"regexp_replace({c}, {q(f'^{T.WS}+|{T.WS}+' + chr(92) + 'z')}, '', 'g')"


def drop(c: str, pattern: str, new: str = "", how: str = "g") -> str:
    return f"regexp_replace({c}, {q(pattern)}, {q(new)}, {q(how)})"


def strip_tags(c: str) -> str:
    return trim(drop(c, T.TAG))


def clean_line(c: str) -> str:
    c = drop(trim(c), T.ROLE)
    c = trim(drop(drop(c, T.OPEN), T.CLOSE))
    return trim(drop(strip_tags(c), f"{T.WS}+", " "))


def clean(c: str) -> str:
    text = trim(f"coalesce({c}, '')")
    opened = drop(drop(text, T.FENCE_OPEN), T.FENCE_CLOSE)
    text = f"case when starts_with({text}, '```') then {opened} else {text} end"
    lines = f"list_filter(list_transform(string_split_regex({text}, {q(T.LINE)}), lambda x: {clean_line('x')}), lambda x: x <> '')"
    return f"coalesce(({lines})[1], '')"


def any_of(c: str, cues) -> str:
    return "(" + " or ".join(f"contains({c}, {q(x)})" for x in cues) + ")"


def reason(c: str, emotion: str) -> str:
    low = f"lower({c})"
    return (
        f"case when length({c}) < {R.LEAST_CHARS} then 'short' when length({c}) > {R.MOST_CHARS} then 'long' when {any_of(low, R.BANNED)} then 'banned' "
        f"when regexp_matches({low}, concat('\\b', {emotion}, '\\b')) and (starts_with({low}, {emotion}) or contains({low}, concat('i am ', {emotion})) "
        f"or contains({low}, concat('i''m ', {emotion}))) then 'names_emotion' end"
    )


def valence(user: str, agent: str) -> str:
    u, a = f"lower({user})", f"lower({agent})"
    good, bad = any_of(u, R.USER_POSITIVE), any_of(u, R.USER_NEGATIVE)
    return f"(({good} and not {bad} and {any_of(a, R.AGENT_CONDOLENCE)}) or ({bad} and not {good} and {any_of(a, R.AGENT_CONGRATS)}))"


def hash_of(key: str) -> str:
    return f"('0x' || substr(md5({key}), 1, 8))::bigint"


def index(key: str, n) -> str:
    return f"({hash_of(key)} % {n})"


def chance(key: str, p: float) -> str:
    return f"({index(key, 1000)} < {round(p * 1000)})"


def pick(key: str, values) -> str:
    return f"([{', '.join(map(q, values))}])[{index(key, len(values))} + 1]"


def case(on: str, table: dict, other: str) -> str:
    return f"case {on} " + " ".join(f"when {q(k)} then {q(v)}" for k, v in table.items()) + f" else {other} end"


def pair_case(a: str, b: str, table: dict, other: str) -> str:
    return "case " + " ".join(f"when {a} = {q(x)} and {b} = {q(y)} then {q(v)}" for (x, y), v in table.items()) + f" else {q(other)} end"


def sentences(c: str) -> str:
    parts = f"list_transform(regexp_extract_all({trim(c)}, {q(T.SENTENCE)}), lambda x: {trim('x')})"
    return f"list_filter({parts}, lambda x: x <> '')"


def words(c: str) -> str:
    return f"list_filter(regexp_extract_all({strip_tags(c)}, {q(T.WORD)}), lambda x: regexp_matches(x, '[A-Za-z0-9]'))"


def tag(emotion: str, seed: str, tags: dict, fixed: dict) -> str:
    out = f"case {emotion}"
    for e, names in tags.items():
        if e in fixed:
            out += f" when {q(e)} then {q(fixed[e])}"
        elif names:
            out += f" when {q(e)} then concat('<|emotion:', {pick(f'concat({seed}, {q(':emo')})', names)}, '|>')"
    return out + " else '' end"


def sound(emotion: str, seed: str, table: dict, full: bool) -> str:
    out, key = f"case {emotion}", f"concat({seed}, ':sfx_pick')"
    for e, options in table.items():
        out += f" when {q(e)} then {pick(key, [f'<|sfx:{n}|>{s}' if full else n for n, s in options])}"
    return out + " end"
