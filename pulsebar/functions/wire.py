"""Wire format of the three feeds, both directions.

Posts are comma-separated text with ``\\,`` for a comma in the text and the
location. Ticks and chats are the text form of a Python tuple.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsebar.functions.clock import civil_text, parse_civil
from pulsebar.functions.text import printable
from pulsebar.layout import CHAT_ITEMS, POST_FIELDS, TICK_ITEMS

# a comma no backslash stands before; the comma comes first, so that other
# characters are passed over at a glance
_FIELD_BREAK = r",(?<!\\,)"
# One tuple item: quoted text of either kind, or a bare word such as a number.
# The loops are unrolled and possessive: Java's matcher would otherwise recurse
# once per character and overflow its stack on long text.
_ITEM = (
    r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
    r'|"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    r"""|[^'", ()]++"""
)
# characters Python's repr writes as a numeric escape
_RARE = r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Z}&&[^ \n\r\t]]"
# what is worth a look for such characters
_NOT_PLAIN = r"[^ -~\n\r\t]"
# stands for an escaped backslash while others are read; repr never leaves it as it is
_MARK = "\ue000"
# stands before the digits of an escape that is longer than JSON's
_LONG_MARK = "\ue001"
# an even run of backslashes that is not itself escaped
_EVEN = r"(?<!\\)((?:\\\\)*+)"


# -- tuple text ---------------------------------------------------------------


def quote(text: Column) -> Column:
    """A string as Python's ``repr`` writes it."""
    has_single = text.contains("'")
    has_double = text.contains('"')
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    body = F.replace(body, F.lit("\n"), F.lit("\\n"))
    body = F.replace(body, F.lit("\r"), F.lit("\\r"))
    body = F.replace(body, F.lit("\t"), F.lit("\\t"))
    # only text with a character left to escape is taken apart; every step
    # names the one before it once, so the expression stays small
    parts = F.split(body, "", F.when(text.rlike(_NOT_PLAIN) & text.rlike(_RARE), -1).otherwise(1))
    body = F.array_join(F.transform(parts, _escape_char), "")
    body = F.replace(body, F.lit("'"), F.when(has_single & has_double, "\\'").otherwise("'"))
    mark = F.when(has_single & ~has_double, F.lit('"')).otherwise(F.lit("'"))
    return F.concat(mark, body, mark)


def quote_plain(text: Column) -> Column:
    """A string known to hold nothing to escape, such as a number or a time."""
    return F.concat(F.lit("'"), text, F.lit("'"))


def _escape_char(char: Column) -> Column:
    code = F.ascii(char)
    digits = F.lower(F.hex(code.cast("bigint")))
    escape = (
        F.when(code <= 0xFF, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
        .when(code <= 0xFFFF, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
        .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
    )
    return F.when(char.rlike(_RARE), escape).otherwise(char)


def unquote(item: Column) -> Column:
    """Text of a tuple item; a bare word stays as it is.

    Escapes nobody knows are left as they stand.
    """
    body = F.substring(item, F.lit(2), F.length(item) - 2)
    numeric = body.contains("\\x") | body.contains("\\u") | body.contains("\\U") | body.contains(_MARK)
    text = (
        F.when(~body.contains("\\"), body)
        .when(numeric, _read_all_escapes(body))
        .otherwise(_read_plain_escapes(body))
    )
    return F.when(item.startswith("'") | item.startswith('"'), text).otherwise(item)


def _read_plain_escapes(body: Column) -> Column:
    """Quotes, backslashes and white space, by plain replacement."""
    for escape, char in (
        ("\\\\", _MARK),
        ("\\'", "'"),
        ('\\"', '"'),
        ("\\n", "\n"),
        ("\\r", "\r"),
        ("\\t", "\t"),
        (_MARK, "\\"),
    ):
        body = F.replace(body, F.lit(escape), F.lit(char))
    return body


def _read_all_escapes(body: Column) -> Column:
    """Numeric escapes too: Spark's JSON reader reads the text once the few
    spellings JSON does not share are rewritten."""
    doc = _read_long_escapes(body)
    doc = F.regexp_replace(doc, _EVEN + r"\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    doc = F.regexp_replace(doc, _EVEN + r"\\'", "$1'")
    doc = F.regexp_replace(doc, _EVEN + r'"', r'$1\\"')
    doc = F.regexp_replace(doc, _EVEN + r'\\(?![\\"nrt]|u[0-9a-fA-F]{4})', r"$1\\\\")
    decoded = F.from_json(
        F.concat(F.lit('{"v":"'), doc, F.lit('"}')), "v string", {"allowUnescapedControlChars": "true"}
    )["v"]
    return F.coalesce(decoded, body)


def _read_long_escapes(body: Column) -> Column:
    """``\\U`` and eight digits, which JSON does not know: the code point itself."""
    marked = F.regexp_replace(body, _EVEN + r"\\U(00(?:0[0-9a-fA-F]|10)[0-9a-fA-F]{4})", f"$1{_LONG_MARK}$2")

    def char(part: Column, place: Column) -> Column:
        point = F.decode(F.unhex(F.substring(part, 1, 8)), "UTF-32")
        return F.when(place == 0, part).otherwise(F.concat(point, F.substring(part, F.lit(9), F.length(part))))

    read = F.array_join(F.transform(F.split(marked, _LONG_MARK), char), "")
    return F.when(body.contains("\\U"), read).otherwise(body)


def tuple_text(*items: Column) -> Column:
    """Tuple text of items that are already in item form."""
    parts: list[Column] = [F.lit("(")]
    for index, item in enumerate(items):
        if index:
            parts.append(F.lit(", "))
        parts.append(item)
    return F.concat(*parts, F.lit(")"))


def tuple_items(value: Column) -> Column:
    """Items of a tuple text as an array of item texts."""
    return F.regexp_extract_all(value, F.lit(_ITEM), F.lit(0))


def is_tuple_of(value: Column, items: Column, size: int) -> Column:
    """True where ``value`` is nothing but a tuple of ``size`` of these items."""
    rebuilt = F.concat(F.lit("("), F.array_join(items, ", "), F.lit(")"))
    return (F.size(items) == size) & (rebuilt == value)


# -- encoders -----------------------------------------------------------------


def encode_post(
    followers: Column,
    friends: Column,
    statuses: Column,
    text: Column,
    screen_name: Column,
    language: Column,
    location: Column,
    created: Column,
) -> Column:
    """Wire text of a post; ``created`` is wall-clock time, or finished text that stays as it is."""
    fields = [
        followers.cast("string"),
        friends.cast("string"),
        statuses.cast("string"),
        _protect(text),
        screen_name,
        language,
        _protect(location),
        F.when(F.typeof(created) == "string", created.cast("string")).otherwise(civil_text(created)),
    ]
    # concat_ws leaves nulls out, which would move the fields behind them
    return printable(F.concat_ws(",", *[F.coalesce(field, F.lit("")) for field in fields]))


def _protect(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("\\,"))


def encode_tick(
    pair: Column,
    last: Column,
    lowest_ask: Column,
    highest_bid: Column,
    percent_change: Column,
    base_volume: Column,
    quote_volume: Column,
    is_frozen: Column,
    high_24h: Column,
    low_24h: Column,
    arrived: Column,
) -> Column:
    """Wire text of a tick; the pair is a plain symbol, prices and volumes are
    number text."""
    return tuple_text(
        quote_plain(pair),
        quote_plain(last),
        quote_plain(lowest_ask),
        quote_plain(highest_bid),
        quote_plain(percent_change),
        quote_plain(base_volume),
        quote_plain(quote_volume),
        is_frozen.cast("string"),
        quote_plain(high_24h),
        quote_plain(low_24h),
        quote_plain(civil_text(arrived)),
    )


def encode_chat(
    kind: Column, number: Column, user: Column, message: Column, reputation: Column, arrived: Column
) -> Column:
    """Wire text of a chat message."""
    return tuple_text(
        quote_plain(kind),
        number.cast("string"),
        quote(user),
        quote(message),
        reputation.cast("string"),
        quote_plain(civil_text(arrived)),
    )


# -- parsers ------------------------------------------------------------------
# Each takes the split message and gives named columns; ``fields`` / ``items``
# has to be a column of its own so that a message is split once.


def split_post(value: Column) -> Column:
    """Fields of a post as an array."""
    return F.split(value, _FIELD_BREAK)


def post_columns(fields: Column) -> dict[str, Column]:
    def text(index: int) -> Column:
        return F.get(fields, index)

    return {
        "followers": text(0).try_cast("bigint"),
        "friends": text(1).try_cast("bigint"),
        "statuses": text(2).try_cast("bigint"),
        "text": _restore(text(3)),
        "screen_name": text(4),
        "language": text(5),
        "location": _restore(text(6)),
        "created": parse_civil(text(7)),
        "texts": F.array(text(0), text(1), text(2)),
    }


def _restore(text: Column) -> Column:
    return F.replace(text, F.lit("\\,"), F.lit(","))


def post_shape(fields: Column) -> Column:
    return F.size(fields) == POST_FIELDS


def _plain(items: Column, index: int) -> Column:
    """An item that holds no escapes: its quotes are all there is to take off."""
    return F.btrim(F.get(items, index), F.lit("'\""))


def tick_columns(items: Column) -> dict[str, Column]:
    def number(index: int) -> Column:
        value = _plain(items, index).try_cast("double")
        # what is not finite is no price: it would make every mean it is in one too
        return F.when(F.abs(value) < float("inf"), value)

    return {
        "pair": _plain(items, 0),
        "last": number(1),
        "lowest_ask": number(2),
        "highest_bid": number(3),
        "percent_change": number(4),
        "base_volume": number(5),
        "quote_volume": number(6),
        "is_frozen": F.get(items, 7).try_cast("int"),
        "high_24h": number(8),
        "low_24h": number(9),
        "ts": parse_civil(_plain(items, 10)),
        "texts": F.array(*[_plain(items, index) for index in range(1, TICK_ITEMS - 1)]),
    }


def tick_shape(value: Column, items: Column) -> Column:
    return is_tuple_of(value, items, TICK_ITEMS)


def chat_columns(items: Column) -> dict[str, Column]:
    return {
        "user": unquote(F.get(items, 2)),
        "message": unquote(F.get(items, 3)),
        "ts": parse_civil(_plain(items, 5)),
    }


def chat_shape(value: Column, items: Column) -> Column:
    return is_tuple_of(value, items, CHAT_ITEMS)
