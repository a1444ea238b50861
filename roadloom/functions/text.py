"""Text functions: ASCII case, exact splits, number checks, and the texts of logs."""

from __future__ import annotations

import string
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_upper(s: Column) -> Column:
    """Upper case of a-z only; other letters keep their case."""
    return F.translate(s, string.ascii_lowercase, string.ascii_uppercase)


def ascii_lower(s: Column) -> Column:
    return F.translate(s, string.ascii_uppercase, string.ascii_lowercase)


def label_key(label: Column) -> Column:
    """A label's lookup key: without leading + and *, in ASCII upper case."""
    return ascii_upper(F.regexp_replace(label, r"^[+*]+", ""))


#: Plain decimals: at most one minus, first; at most one point; digits else.
NUMBER = r"^(\.[0-9]*|-[0-9]*\.?[0-9]*|[0-9]+\.?[0-9]*)$"


def is_number(s: Column) -> Column:
    """Whether the text up to the first & is a plain decimal."""
    return F.substring_index(s, "&", 1).rlike(NUMBER)


def fields(s: Column, delimiter: str, n: int) -> Column:
    """The fields if there are exactly n, else null; trailing empty fields count."""
    parts = F.split(s, "\\Q" + delimiter + "\\E", -1)
    return F.when(F.size(parts) == n, parts)


def fixed(x: Column, digits: int) -> Column:
    """A double with so many decimals, rounded as C does: by its exact binary value, a true half to the even digit. format_string
    rounds halves of the shortest text up instead (3.125 to 3.13, 1.005 to 1.01). From 2**43 on there is no half to tell apart."""
    scale, a = F.lit(10.0**digits), F.abs(x)
    near = a * scale
    # where the product is a half, what it lost tells the side: the number's upper and lower bits times the scale are exact
    big = a * F.lit(134217729.0)
    high = big - (big - a)
    lost = (high * scale - near) + (a - high) * scale
    units = F.rint(near + F.when(near - F.floor(near) == 0.5, F.signum(lost) * 0.25).otherwise(0.0))
    sign = F.when(x < 0, "-").when((x == 0) & x.cast("string").startswith("-"), "-").otherwise("")
    # the number stands in the text of generated code but some twenty times: more often, code of several such texts is too long to compile
    exact = F.concat(sign, (units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-digits))).cast("string"))
    return F.when(a < float(1 << 43), exact).otherwise(F.format_string(f"%.{digits}f", x))


def of_miles(part: Column, whole: Column) -> Column:
    """`x of y mi (p%)`, or -.--% if the whole is 0."""
    share = F.when(whole == 0, F.lit("-.--%")).otherwise(F.concat(fixed(F.try_divide(part * 100.0, whole), 2), F.lit("%")))
    return F.concat(fixed(part, 2), F.lit(" of "), fixed(whole, 2), F.lit(" mi ("), share, F.lit(")"))


def quoted(s: Column) -> Column:
    """The text with every single quote doubled, as SQL text wants it."""
    return F.replace(s, F.lit("'"), F.lit("''"))


def six_digits(line: Column) -> Column:
    """A waypoint line with its latitude and longitude written with six decimals."""
    lat, lon = F.regexp_extract(line, r"lat=(-?[0-9.]+)", 1), F.regexp_extract(line, r"lon=(-?[0-9.]+)", 1)
    six = lambda x: F.format_string("%.6f", F.expr("0D") + x.try_cast("double"))
    with_lat = F.replace(line, F.concat(F.lit("lat="), lat), F.concat(F.lit("lat="), six(lat)))
    return F.when((lat == "") | (lon == ""), line).otherwise(F.replace(with_lat, F.concat(F.lit("lon="), lon), F.concat(F.lit("lon="), six(lon))))


def names_route(label: Column, route: Column, banner: Column, abbrev: Column) -> Column:
    """Whether a label refers to a route: its name, with or without the abbrev, alone or before an underscore."""
    short, full = F.concat(route, banner), F.concat(route, banner, abbrev)
    return (label == short) | (label == full) | label.startswith(F.concat(short, F.lit("_"))) | label.startswith(F.concat(full, F.lit("_")))


def reversed_border(label: Column) -> Column:
    """`AAA/BBB` turned to `BBB/AAA`; other labels stay."""
    at = F.instr(label, "/")
    return F.when(at > 0, F.concat(F.substring_index(label, "/", -1), F.lit("/"), F.substring_index(label, "/", 1))).otherwise(label)


def fifteen_digits(x: Column) -> Column:
    """15 significant digits without trailing zeros, as C's %.15g: plain decimals from 0.0001 to below 10**15, else with an
    exponent; a negative zero keeps its sign.

    Exact for numbers whose shortest text has 15 digits at most, as coordinates read from files have; of others that text is
    rounded."""
    whole = F.length(F.floor(F.abs(x)).cast("decimal(20,0)").cast("string"))
    # below one, zeros behind the point are no significant digits
    ahead = F.when(F.abs(x) >= 1, whole).otherwise(F.ceil(F.log10(F.abs(x)) + F.lit(1e-15)).cast("int"))
    text = lambda digits: F.format_string(f"%.{digits}f", x)
    places = F.when(x == 0, F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(F.lit(19), F.lit(15) - ahead)))
    every = F.element_at(F.array(*[text(k) for k in range(20)]), (places + 1).cast("int"))
    plain = F.when(F.contains(every, F.lit(".")), F.regexp_replace(every, r"\.?0+$", "")).otherwise(every)
    power = F.regexp_replace(F.format_string("%.14e", x), r"\.?0+e", "e")
    return F.when(x == 0, F.when(x.cast("string").startswith("-"), "-0").otherwise("0")).when((F.abs(x) < 0.0001) | (F.abs(x) >= 1e15), power).when(x.isNotNull(), plain)


def _fitting(s: Column, n: int, part: Callable[[Column], Column]) -> Column:
    """The most characters of which part(k) has n bytes of UTF-8 at most; a character has one byte at least."""
    upto = F.sequence(F.lit(0), F.least(F.lit(n), F.length(s)))
    return F.array_max(F.filter(upto, lambda k: F.octet_length(part(k)) <= n))


def cut_bytes(s: Column, n: int) -> Column:
    """The most whole characters from the start that fit into n bytes of UTF-8."""
    return F.when(F.octet_length(s) <= n, s).otherwise(F.left(s, _fitting(s, n, lambda k: F.left(s, k))))


def end_bytes(s: Column, n: int) -> Column:
    """The most whole characters at the end that fit into n bytes of UTF-8."""
    return F.when(F.octet_length(s) <= n, s).otherwise(F.right(s, _fitting(s, n, lambda k: F.right(s, k))))


def shortened(s: Column, n: int) -> Column:
    """The text if it has n bytes at most, else its start and three dots, n bytes in all at most."""
    return F.when(F.octet_length(s) <= n, s).otherwise(F.concat(cut_bytes(s, n - 3), F.lit("...")))


def without_controls(line: Column) -> Column:
    """Control characters other than the tab shown as ?."""
    return F.regexp_replace(line, "[\\x00-\\x08\\x0A-\\x1F\\x7F]", "?")
