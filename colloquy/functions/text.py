"""Text rules as column expressions.

White space is that of Unicode, line and information separators included; words for \\w and \\b
are ASCII.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.functions import rules as R
from colloquy.functions.hashing import pick, stable_chance

WS = r"[\t-\r\x1C-\x20\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WHITE = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))  # the same characters
TAG = r"<\|[^|]+\|>"
LINE = r"\r\n|[\n\r\x0B\f\x1C\x1D\x1E\x{0085}\x{2028}\x{2029}]"
ROLE = rf"(?i)^(user|assistant|agent|a|b){WS}*:{WS}*"
OPEN, CLOSE = "^[\"“'`]+", "[\"”'`]+\\z"
FENCE_OPEN, FENCE_CLOSE = rf"^```(?:\w+)?{WS}*", rf"{WS}*```\z"
SENTENCE = r"(?s).+?(?:[.!?]+[\"']*|\z)"
WORD = r"[A-Za-z0-9']+"
SPOKEN = r"(?<!')'*+[A-Za-z0-9][A-Za-z0-9']*"  # a WORD that is not of quotes alone


def trim(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))  # looks at the ends only


def strip_tags(c: Column) -> Column:
    return trim(F.regexp_replace(c, TAG, ""))


def clean_line(c: Column) -> Column:
    """A line without role prefix, wrapping quotes and tags, its white space collapsed."""
    c = F.regexp_replace(trim(c), ROLE, "")
    c = trim(F.regexp_replace(F.regexp_replace(c, OPEN, ""), CLOSE, ""))
    return trim(F.regexp_replace(strip_tags(c), f"{WS}+", " "))


def clean_utterance(raw: Column) -> Column:
    """The first line that is not empty once cleaned; '' if there is none, and for null."""
    text = trim(F.coalesce(raw, F.lit("")))
    open_ = F.regexp_replace(F.regexp_replace(text, FENCE_OPEN, ""), FENCE_CLOSE, "")
    text = F.when(text.startswith("```"), open_).otherwise(text)
    # lines after the first that is left are not cleaned
    return F.aggregate(F.split(text, LINE), F.lit(""), lambda found, x: F.when(found != "", found).otherwise(clean_line(x)))


def _any(c: Column, cues) -> Column:
    """Does any of the substrings occur?  One alternation instead of a scan for each."""
    return c.rlike("|".join(r"\Q" + x + r"\E" for x in cues))


def reject_reason(clean: Column, emotion: Column, most: int = R.MOST_CHARS) -> Column:
    """Why a cleaned line is unusable; null if it is usable."""
    low, n = F.lower(clean), F.length(clean)
    named = F.regexp_like(low, F.concat(F.lit(r"\b\Q"), emotion, F.lit(r"\E\b")))
    subject = low.startswith(emotion) | F.contains(low, F.concat(F.lit("i am "), emotion)) | F.contains(low, F.concat(F.lit("i'm "), emotion))
    return (
        F.when(n < R.LEAST_CHARS, "short").when(n > most, "long").when(_any(low, R.BANNED), "banned")
        .when(named & subject, "names_emotion")
    )


def valence_mismatch(user: Column, agent: Column) -> Column:
    """Is good news answered as bad, or bad as good?  Cues are substrings, not words."""
    user, agent = F.lower(F.coalesce(user, F.lit(""))), F.lower(F.coalesce(agent, F.lit("")))
    good, bad = _any(user, R.USER_POSITIVE), _any(user, R.USER_NEGATIVE)
    return (good & ~bad & _any(agent, R.AGENT_CONDOLENCE)) | (bad & ~good & _any(agent, R.AGENT_CONGRATS))


def split_sentences(c: Column) -> Column:
    parts = F.transform(F.regexp_extract_all(trim(c), F.lit(SENTENCE), F.lit(0)), trim)
    return F.filter(parts, lambda x: x != "")


def tokenize_words(c: Column) -> Column:
    return F.regexp_extract_all(strip_tags(c), F.lit(SPOKEN), F.lit(0))


def text_prompt(emotion: Column, template: str = R.TEXT_PROMPT) -> Column:
    """The template with {emotion} filled; a template with other placeholders, or none, stays as it is."""
    import string

    try:
        fields = {f for _, f, _, _ in string.Formatter().parse(template) if f is not None}
    except ValueError:
        fields = set()
    return F.replace(F.lit(template), F.lit("{emotion}"), emotion) if fields == {"emotion"} else F.lit(template)


def system_wrap(c: Column, tag: str = "<system>") -> Column:
    text = trim(c)
    return F.when(text.startswith(tag) & text.endswith(tag), text).otherwise(F.concat(F.lit(f"{tag} "), text, F.lit(f" {tag}")))


def _with_sound(prefix: Column, plain: Column, sound: Column) -> Column:
    comma = F.when(plain.rlike(r"^\p{L}"), ", ").otherwise("")
    return F.concat(prefix, sound, comma, plain)


def _sounds(emotion: Column, seed: Column, table: dict) -> tuple[Column, Column]:
    """(name, chunk) of the picked sound; null where the emotion has none."""
    name = chunk = F.lit(None).cast("string")
    for e, options in table.items():
        key = F.concat(seed, F.lit(":sfx_pick"))
        name = F.when(emotion == e, pick(key, tuple(n for n, _ in options))).otherwise(name)
        chunk = F.when(emotion == e, pick(key, tuple(f"<|sfx:{n}|>{s}" for n, s in options))).otherwise(chunk)
    return name, chunk


def _tag(emotion: Column, seed: Column, tags: dict, fixed: dict) -> Column:
    out = F.lit("")
    for e, names in tags.items():
        if e in fixed:
            out = F.when(emotion == e, fixed[e]).otherwise(out)
        elif names:
            out = F.when(emotion == e, F.concat(F.lit("<|emotion:"), pick(F.concat(seed, F.lit(":emo")), names), F.lit("|>"))).otherwise(out)
    return out


def tag_speech_pool(emotion: Column, text: Column, seed: Column) -> Column:
    """Emotion tag, and by chance a sound: laughter and crying after the first of several sentences, others in front."""
    plain = strip_tags(text)
    prefix = _tag(emotion, seed, R.POOL_TAGS, R.POOL_PREFIX)
    name, chunk = _sounds(emotion, seed, R.POOL_SOUNDS)
    parts, key = split_sentences(plain), F.concat(seed, F.lit(":sfx"))
    rest = F.array_join(F.slice(parts, 2, 1 << 20), " ")
    middle = F.concat(prefix, F.try_element_at(parts, F.lit(1)), chunk, F.when(rest.rlike(r"^\p{L}"), " ").otherwise(""), rest)
    return (
        F.when(name.isin(*R.MID_TURN) & (F.size(parts) >= 2) & stable_chance(key, R.MID_TURN_SHARE), middle)
        .when(name.isNotNull() & ~name.isin(*R.MID_TURN) & stable_chance(key, R.SOUND_SHARE), _with_sound(prefix, plain, chunk))
        .otherwise(F.concat(prefix, plain))
    )


def tag_speech_pair(emotion: Column, text: Column, seed: Column) -> Column:
    plain = strip_tags(text)
    prefix = _tag(emotion, seed, R.PAIR_TAGS, {})
    name, chunk = _sounds(emotion, seed, R.PAIR_SOUNDS)
    hit = name.isNotNull() & stable_chance(F.concat(seed, F.lit(":sfx")), R.SOUND_SHARE)
    return F.when(hit, _with_sound(prefix, plain, chunk)).otherwise(F.concat(prefix, plain))


def subword_tokens(c: Column, size: int = 4, vocabulary: int = 32_000, newline: int = 4, bos: int | None = None) -> Column:
    """Stand-in tokenizer: words cut into pieces of `size` characters, each numbered by its hash.

    Lines are joined by the newline's id.  A real tokenizer takes this column's place.
    """
    number = lambda p: F.conv(F.substring(F.md5(p), 1, 8), 16, 10).cast("long") % (vocabulary - 10) + 10
    line = lambda t: F.transform(F.regexp_extract_all(t, F.lit(r"[^ \t]{1,%d}" % size), F.lit(0)), number)
    lines = F.transform(F.split(c, "\n"), line)
    ids = F.flatten(F.transform(lines, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.array(F.lit(newline).cast("long")), x))))
    return ids if bos is None else F.concat(F.array(F.lit(bos).cast("long")), ids)
