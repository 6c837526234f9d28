"""Content hashes and deterministic ids: PREFIX_{hash of episode}_{position}_{hash of content}."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import json_number, round_half_even_2

PREFIX = {"utterance": "utt", "span": "spn", "beat": "bet", "section": "sec"}
#: Lengths of the hashes and of the position.
EPISODE_HASH, CONTENT_HASH, TEXT_HASH, POSITION = 12, 8, 16, 6


def content_hash(c: Column, algorithm: str = "sha256") -> Column:
    """The hex digest of a text in UTF-8."""
    if algorithm == "md5":
        return F.md5(c)
    if algorithm == "sha1":
        return F.sha1(c)
    if algorithm.startswith("sha") and algorithm[3:] in ("224", "256", "384", "512"):
        return F.sha2(c, int(algorithm[3:]))
    raise ValueError(f"unknown algorithm {algorithm!r}")


def json_string(c: Column) -> Column:
    """A JSON string literal; non-ASCII characters stay."""
    out = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    short = F.create_map(*[F.lit(x) for pair in {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}.items() for x in pair])

    def one(ch: Column) -> Column:
        code = F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(F.ascii(ch))), 4, "0"))
        return F.coalesce(F.try_element_at(short, ch), F.when((ch < " ") & (ch != ""), code).otherwise(ch))

    # Control characters are rare: only texts with one are taken apart.
    escaped = F.when(c.rlike(r"[\x00-\x1f]"), F.array_join(F.transform(F.split(out, ""), one), "")).otherwise(out)
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def json_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(items, json_string), ", "), F.lit("]"))


def json_object(fields: dict[str, Column]) -> Column:
    """A JSON object with sorted keys, as `", "` and `": "` separate them; values are JSON texts."""
    parts: list[Column] = []
    for k in sorted(fields):
        parts += [F.lit(f'{"," if parts else "{"}{" " if parts else ""}"{k}": '), fields[k]]
    return F.concat(*parts, F.lit("}"))


def time_text(literal: Column | None, value: Column) -> Column:
    """A time of an utterance id: integers as they were written, others rounded to two places."""
    number = json_number(round_half_even_2(value))
    return number if literal is None else F.when(literal.rlike(r"^-?\d+$"), literal).otherwise(number)


def _id(kind: str, episode: Column, position: Column, content: dict[str, Column]) -> Column:
    return F.concat_ws(
        "_", F.lit(PREFIX[kind]), F.substring(content_hash(episode), 1, EPISODE_HASH), F.lpad(position.cast("string"), POSITION, "0"),
        F.substring(content_hash(json_object(content)), 1, CONTENT_HASH),
    )


def text_key(text: Column) -> Column:
    return json_string(F.substring(content_hash(text), 1, TEXT_HASH))


def utterance_id(episode: Column, position: Column, text: Column, speaker: Column, start: Column, end: Column, start_literal: Column | None = None, end_literal: Column | None = None) -> Column:
    return _id("utterance", episode, position, {"text": json_string(text), "speaker": json_string(speaker), "start": time_text(start_literal, start), "end": time_text(end_literal, end)})


def span_id(episode: Column, position: Column, speaker: Column, utterance_ids: Column, text: Column) -> Column:
    return _id("span", episode, position, {"speaker": json_string(speaker), "utterance_ids": json_list(F.array_sort(utterance_ids)), "text_hash": text_key(text)})


def beat_id(episode: Column, position: Column, span_ids: Column, text: Column) -> Column:
    return _id("beat", episode, position, {"span_ids": json_list(F.array_sort(span_ids)), "text_hash": text_key(text)})


def section_id(episode: Column, position: Column, beat_ids: Column, text: Column) -> Column:
    return _id("section", episode, position, {"beat_ids": json_list(F.array_sort(beat_ids)), "text_hash": text_key(text)})


def valid_id(c: Column, kind: str) -> Column:
    """Four parts: the kind's prefix, hashes of 12 and 8 characters, and a position of 6 digits between them."""
    return F.coalesce(c.rlike(f"^{PREFIX[kind]}_[^_]{{12}}_[0-9]{{6}}_[^_]{{8}}$"), F.lit(False))
