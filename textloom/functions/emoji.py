"""Emoji masking and restoring as native expressions.

What is an emoji is decided by ranges of code points with modifiers, joiners, flags, keycaps and tag
sequences; a symbol that shows as text by default counts with and without the emoji selector.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import BLANK, SPACE, bound

# The Unicode standard's code points with the property Emoji, but for digits, # and *.
PICTURE = (
    r"\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{2199}\x{21A9}-\x{21AA}\x{231A}-\x{231B}\x{2328}\x{23CF}\x{23E9}-\x{23F3}"
    r"\x{23F8}-\x{23FA}\x{24C2}\x{25AA}-\x{25AB}\x{25B6}\x{25C0}\x{25FB}-\x{25FE}\x{2600}-\x{2604}\x{260E}\x{2611}\x{2614}-\x{2615}"
    r"\x{2618}\x{261D}\x{2620}\x{2622}-\x{2623}\x{2626}\x{262A}\x{262E}-\x{262F}\x{2638}-\x{263A}\x{2640}\x{2642}\x{2648}-\x{2653}"
    r"\x{265F}-\x{2660}\x{2663}\x{2665}-\x{2666}\x{2668}\x{267B}\x{267E}-\x{267F}\x{2692}-\x{2697}\x{2699}\x{269B}-\x{269C}\x{26A0}-\x{26A1}"
    r"\x{26A7}\x{26AA}-\x{26AB}\x{26B0}-\x{26B1}\x{26BD}-\x{26BE}\x{26C4}-\x{26C5}\x{26C8}\x{26CE}-\x{26CF}\x{26D1}\x{26D3}-\x{26D4}"
    r"\x{26E9}-\x{26EA}\x{26F0}-\x{26F5}\x{26F7}-\x{26FA}\x{26FD}\x{2702}\x{2705}\x{2708}-\x{270D}\x{270F}\x{2712}\x{2714}\x{2716}"
    r"\x{271D}\x{2721}\x{2728}\x{2733}-\x{2734}\x{2744}\x{2747}\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}\x{2763}-\x{2764}\x{2795}-\x{2797}"
    r"\x{27A1}\x{27B0}\x{27BF}\x{2934}-\x{2935}\x{2B05}-\x{2B07}\x{2B1B}-\x{2B1C}\x{2B50}\x{2B55}\x{3030}\x{303D}\x{3297}\x{3299}"
    r"\x{1F004}\x{1F0CF}\x{1F170}-\x{1F171}\x{1F17E}-\x{1F17F}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F201}-\x{1F202}\x{1F21A}\x{1F22F}"
    r"\x{1F232}-\x{1F23A}\x{1F250}-\x{1F251}\x{1F300}-\x{1F321}\x{1F324}-\x{1F393}\x{1F396}-\x{1F397}\x{1F399}-\x{1F39B}\x{1F39E}-\x{1F3F0}"
    r"\x{1F3F3}-\x{1F3F5}\x{1F3F7}-\x{1F4FD}\x{1F4FF}-\x{1F53D}\x{1F549}-\x{1F54E}\x{1F550}-\x{1F567}\x{1F56F}-\x{1F570}\x{1F573}-\x{1F57A}"
    r"\x{1F587}\x{1F58A}-\x{1F58D}\x{1F590}\x{1F595}-\x{1F596}\x{1F5A4}-\x{1F5A5}\x{1F5A8}\x{1F5B1}-\x{1F5B2}\x{1F5BC}\x{1F5C2}-\x{1F5C4}"
    r"\x{1F5D1}-\x{1F5D3}\x{1F5DC}-\x{1F5DE}\x{1F5E1}\x{1F5E3}\x{1F5E8}\x{1F5EF}\x{1F5F3}\x{1F5FA}-\x{1F64F}\x{1F680}-\x{1F6C5}\x{1F6CB}-\x{1F6D2}"
    r"\x{1F6D5}-\x{1F6D7}\x{1F6DC}-\x{1F6E5}\x{1F6E9}\x{1F6EB}-\x{1F6EC}\x{1F6F0}\x{1F6F3}-\x{1F6FC}\x{1F7E0}-\x{1F7EB}\x{1F7F0}"
    r"\x{1F90C}-\x{1F93A}\x{1F93C}-\x{1F945}\x{1F947}-\x{1F9FF}\x{1FA70}-\x{1FA7C}\x{1FA80}-\x{1FA89}\x{1FA8F}-\x{1FAC6}\x{1FACE}-\x{1FADC}"
    r"\x{1FADF}-\x{1FAE9}\x{1FAF0}-\x{1FAF8}"
)
_ONE = rf"[{PICTURE}]\x{{FE0F}}?[\x{{1F3FB}}-\x{{1F3FF}}]?(?:[\x{{E0020}}-\x{{E007E}}]+\x{{E007F}})?"
#: What an emoji can begin with, roughly: a few ranges that rule out most characters at once.
_AHEAD = r"(?=[[^:-\x{A8}\x20-\x22+-/\x{AF}-\x{203B}]&&[#*0-9\x{A9}\x{AE}\x{203C}-\x{3299}\x{1F004}-\x{1FAF8}]])"
EMOJI = rf"{_AHEAD}(?:[\x{{1F1E6}}-\x{{1F1FF}}]{{2}}|[0-9#*]\x{{FE0F}}?\x{{20E3}}|{_ONE}(?:\x{{200D}}{_ONE})*+)"
_REPLACEMENTS = "array<struct<token:string,emoji:string,glue_left:boolean,glue_right:boolean>>"


def contains_emoji(text: Column) -> Column:
    return F.coalesce(text.rlike(EMOJI), F.lit(False))


def mask(text: Column) -> Column:
    """struct<masked_text, replacements, contains_emoji>: the i-th emoji becomes a word of its own.

    A replacement says which emoji it stands for and whether it touched its neighbours. White space is
    collapsed only where an emoji was found.
    """
    plain = lambda t: F.struct(t.alias("masked_text"), F.array().cast(_REPLACEMENTS).alias("replacements"), F.lit(False).alias("contains_emoji"))
    parts = lambda t: F.struct(F.regexp_extract_all(t, F.lit(EMOJI), F.lit(0)).alias("found"), F.split(t, EMOJI, -1).alias("pieces"))
    return bound(text, lambda t: F.when(contains_emoji(t), bound(parts(t), lambda p: _masked(p["found"], p["pieces"]))).otherwise(plain(t)))


def _masked(found: Column, pieces: Column) -> Column:
    """The struct that `mask` gives, of a text's emoji (at least one) and what lies around them."""
    token = lambda i: F.concat(F.lit("__EMOJI_"), i.cast("string"), F.lit("__"))
    spaced = F.concat(F.transform(found, lambda _, i: F.concat(F.lit(" "), token(i), F.lit(" "))), F.array(F.lit("")))
    whole = F.array_join(F.zip_with(pieces, spaced, lambda a, b: F.concat(a, b)), "")
    tidy = F.btrim(F.regexp_replace(whole, f"{BLANK}+", " "), F.lit(" "))

    def left(i: Column) -> Column:
        # An empty piece between two emoji still means that they touch; at the start there is no neighbour.
        piece = F.get(pieces, i)
        return F.when(piece == "", i > 0).otherwise(~F.right(piece, F.lit(1)).rlike(f"[{SPACE}]"))

    def right(i: Column) -> Column:
        piece = F.get(pieces, i + 1)
        return F.when(piece == "", i + 1 < F.size(found)).otherwise(~F.left(piece, F.lit(1)).rlike(f"[{SPACE}]"))

    replacements = F.transform(found, lambda e, i: F.struct(token(i).alias("token"), e.alias("emoji"), left(i).alias("glue_left"), right(i).alias("glue_right")))
    return F.struct(tidy.alias("masked_text"), replacements.alias("replacements"), F.lit(True).alias("contains_emoji"))


def unmask(text: Column, replacements: Column) -> Column:
    """Puts emoji back for their tokens, with the spaces around a token kept where nothing touched it.

    A token between spaces is replaced wherever it stands; else what a model left of its surroundings is tried
    in turn: a space after, a space before, the bare token.
    """

    def restore(state: Column, r: Column) -> Column:
        token = r["token"]
        shown = F.concat(F.when(r["glue_left"], "").otherwise(" "), r["emoji"], F.when(r["glue_right"], "").otherwise(" "))
        spaced = F.concat(F.lit(" "), token, F.lit(" "))
        loose = F.replace(state, F.concat(token, F.lit(" ")), shown)
        loose = F.replace(loose, F.concat(F.lit(" "), token), shown)
        return F.when(F.contains(state, spaced), F.replace(state, spaced, shown)).otherwise(F.replace(loose, token, r["emoji"]))

    return F.aggregate(replacements, text, restore)
