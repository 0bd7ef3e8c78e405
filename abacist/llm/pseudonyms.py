"""Format-preserving pseudonyms for personal numbers, dates and addresses, in DataFrame functions only.

What a text holds of these kinds is validated and replaced within its format by
a keyed permutation (a Feistel network with SHA-256 rounds), so equal values get
equal pseudonyms in every document and different values different ones. Cards
keep a valid check digit, social security numbers stay valid numbers and
telephone numbers keep their layout (a usual area code and exchange stay usual),
dates stay dates, IPv4 addresses stay addresses, and the local part of an e-mail
address keeps its letters and digits in their places. A permutation may map a
value to itself; for short local parts that happens now and then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.llm.lines import bound

ROUNDS = 8

CARD_DIGITS = (13, 19)
BLOCK = 64

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)++"
ADDRESS = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
YEAR_FIRST = r"(?<!\d)\d{4}([-/.])\d{2}\1\d{2}(?!\d)"
YEAR_LAST = r"(?<!\d)\d{1,2}(?:/\d{1,2}/|\.\d{1,2}\.)\d{4}(?!\d)"
SOCIAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
MARKED_PHONE = r"(?<!\w)(?:\+1[ .-]?(?:\(\d{3}\) ?|\d{3}[ .-])|(?:1[ .-]?)?\(\d{3}\) ?)\d{3}[ .-]\d{4}(?!\d)"
PLAIN_PHONE = r"(?<!\w)(?:1[ .-]?)?[2-9]\d{2}[ .-][2-9]\d{2}[ .-]\d{4}(?!\d)"
PHONE = f"{MARKED_PHONE}|{PLAIN_PHONE}"
"""Ten digits of any kind if parentheses or +1 mark them, else only as area codes and exchanges are given out."""
CARD = r"(?<![\d.-])\d(?:[ -]?\d){12,}+"
"""Digits among which a card may stand, beside other numbers."""

KINDS = (EMAIL, ADDRESS, YEAR_FIRST.replace("([-/.])", "[-/.]").replace(r"\1", "[-/.]"), YEAR_LAST, SOCIAL, PHONE)
ANY = "|".join(f"(?:{kind})" for kind in KINDS)

FIRST_DAY, DAYS = "1600-01-01", (378, 773)
"""800 years from this day, as a product: two whole cycles of the calendar."""


def _whole(kind: str) -> str:
    return f"^(?:{kind})$"


def _draw(key: str, kind: str, number: Column, value: Column) -> Column:
    """Sixty keyed bits of a round and the other half."""
    told = F.concat(F.lit(f"{key}|{kind}|"), number.cast("string"), F.lit("|"), value.cast("string"))
    return F.conv(F.substr(F.sha2(told, 256), F.lit(1), F.lit(15)), 16, 10).cast("long")


def permuted(key: str, kind: str, left: Column, right: Column, sizes: tuple[int, int]) -> Column:
    """``left, right`` below their sizes, permuted as a pair."""

    def step(pair: Column, number: Column) -> Column:
        turned = (pair["left"] + _draw(key, kind, number, pair["right"]) % sizes[0]) % sizes[0]
        other = (pair["right"] + _draw(key, kind, number, pair["left"]) % sizes[1]) % sizes[1]
        even = number % 2 == 0
        return F.struct(F.when(even, turned).otherwise(pair["left"]).alias("left"), F.when(even, pair["right"]).otherwise(other).alias("right"))

    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _turned(text: Column, digest: Column) -> Column:
    """Every letter and digit moved within its kind, by two digits of the digest."""

    def one(letter: Column, i: Column) -> Column:
        by = F.conv(F.substr(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        moved = letter
        for first, size in (("a", 26), ("A", 26), ("0", 10)):
            inside = letter.between(first, chr(ord(first) + size - 1))
            moved = F.when(inside, F.chr((F.ascii(letter) - ord(first) + by) % size + ord(first))).otherwise(moved)
        return moved

    return F.array_join(F.transform(F.split(text, "", -1), one), "")


def permuted_text(key: str, kind: str, text: Column) -> Column:
    """ASCII text with its letters and digits permuted, each within its kind and place."""

    def step(pair: Column, number: Column) -> Column:
        even = number % 2 == 0

        def digest(other: Column) -> Column:
            return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), number.cast("string"), F.lit("|"), other), 256)

        left = F.when(even, _turned(pair["left"], digest(pair["right"]))).otherwise(pair["left"])
        right = F.when(even, pair["right"]).otherwise(_turned(pair["right"], digest(pair["left"])))
        return F.struct(left.alias("left"), right.alias("right"))

    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), half).alias("left"), F.substr(text, half + 1).alias("right"))
    return bound(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step), lambda pair: F.concat(pair["left"], pair["right"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refilled(text: Column, digits: Column) -> Column:
    """The text with its digits replaced in order."""
    between = F.split(text, "[0-9]", -1)
    return F.array_join(F.zip_with(between, F.split(digits, "", -1), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def _number(text: Column, start: int, length: int) -> Column:
    return F.substr(text, F.lit(start), F.lit(length)).cast("long")


def _padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def _check_digit(payload: Column) -> Column:
    """The last digit that makes a card number valid."""

    def worth(digit: Column, i: Column) -> Column:
        value = digit.cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(value > 9, value - 9).otherwise(value)

    worths = F.transform(F.split(F.reverse(payload), "", -1), worth)
    return ((10 - F.aggregate(worths, F.lit(0), lambda total, x: total + x) % 10) % 10).cast("string")


def _valid(digits: Column) -> Column:
    return _check_digit(F.substr(digits, F.lit(1), F.length(digits) - 1)) == F.substr(digits, F.length(digits))


def _card(key: str, text: Column) -> Column:
    def of(digits: Column) -> Column:
        payload = F.substr(digits, F.lit(1), F.length(digits) - 1)
        return bound(permuted_text(key, "card", payload), lambda new: _refilled(text, F.concat(new, _check_digit(new))))

    return bound(_digits(text), of)


def _chosen_cards(pieces: Column) -> Column:
    """First piece and number of pieces of the valid cards, the longest first where they overlap.

    "First" is within a block of starts, so that a card need only be compared with those chosen
    in its block and the one before it, however long the run of digits is.
    """

    def begun(i: Column) -> Column:
        def sized(count: Column) -> Column:
            digits = _digits(F.array_join(F.slice(pieces, i + 1, count), ""))
            return F.struct((-F.length(digits)).alias("less"), i.alias("start"), count.alias("size"), digits.alias("digits"))

        sizes = F.sequence(F.lit(1), F.least(F.lit(CARD_DIGITS[1]), F.size(pieces) - i))
        return F.filter(F.transform(sizes, sized), lambda c: c["less"].between(-CARD_DIGITS[1], -CARD_DIGITS[0]) & _valid(c["digits"]))

    def in_block(block: Column) -> Column:
        last = F.least(F.size(pieces), (block + 1) * BLOCK) - 1
        return F.array_sort(F.flatten(F.transform(F.sequence(block * BLOCK, last), begun)))

    def placed(c: Column) -> Column:
        return F.struct(c["start"].alias("start"), c["size"].alias("size"))

    def taken(near: Column, c: Column) -> Column:
        meets = F.exists(near, lambda o: (o["start"] < c["start"] + c["size"]) & (c["start"] < o["start"] + o["size"]))
        return F.when(meets, near).otherwise(F.concat(near, F.array(placed(c))))

    none = F.array().cast("array<struct<start:int,size:int>>")

    def next_block(state: Column, block: Column) -> Column:
        def own(near: Column) -> Column:
            mine = F.filter(near, lambda o: o["start"] >= block * BLOCK)
            return bound(mine, lambda m: F.struct(F.concat(state["chosen"], m).alias("chosen"), m.alias("before")))

        return bound(F.aggregate(in_block(block), state["before"], taken), own)

    blocks = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / BLOCK).cast("int"))
    start = F.struct(none.alias("chosen"), none.alias("before"))
    return F.array_sort(F.aggregate(blocks, start, next_block, lambda state: state["chosen"]))


def _cards(key: str, run: Column) -> Column:
    """``text, n_found, n_replaced`` of a run of digits; one without a valid card counts as one found."""

    def of(pieces: Column) -> Column:
        def renamed(c: Column) -> Column:
            old = F.array_join(F.slice(pieces, c["start"] + 1, c["size"]), "")
            return F.struct(c["start"].alias("start"), c["size"].alias("size"), old.alias("old"), _card(key, old).alias("new"))

        def joined(cards: Column) -> Column:
            def upto(i: Column) -> Column:
                return F.when(i == 0, 0).otherwise(F.get(cards, i - 1)["start"] + F.get(cards, i - 1)["size"])

            def ahead(c: Column, i: Column) -> Column:
                return F.concat(F.array_join(F.slice(pieces, upto(i) + 1, c["start"] - upto(i)), ""), c["new"])

            rest = F.array_join(F.slice(pieces, upto(F.size(cards)) + 1, F.size(pieces)), "")
            told = F.concat(F.array_join(F.transform(cards, ahead), ""), rest)
            changed = F.size(F.filter(cards, lambda c: c["old"] != c["new"]))
            return F.struct(told.alias("text"), F.greatest(F.size(cards), F.lit(1)).alias("n_found"), changed.alias("n_replaced"))

        return bound(F.transform(_chosen_cards(pieces), renamed), joined)

    return bound(F.regexp_extract_all(run, F.lit("[0-9]+[ -]?"), 0), of)


def _without_cards(key: str, text: Column) -> Column:
    """``text, n_found, n_replaced`` of what lies between the other kinds."""

    def of(runs: Column) -> Column:
        def joined(new: Column) -> Column:
            gaps = F.split(text, CARD, -1)
            told = F.array_join(F.zip_with(gaps, new["text"], lambda gap, value: F.concat(gap, F.coalesce(value, F.lit("")))), "")
            return F.struct(told.alias("text"), *[_total(new[c]).alias(c) for c in ("n_found", "n_replaced")])

        none = F.struct(text.alias("text"), F.lit(0).alias("n_found"), F.lit(0).alias("n_replaced"))
        return F.when(F.size(runs) > 0, bound(F.transform(runs, lambda run: _cards(key, run)), joined)).otherwise(none)

    return bound(F.regexp_extract_all(text, F.lit(CARD), 0), of)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _phone(key: str, text: Column) -> Column:
    """Two permutations that share the ten digits: numbers that are told without marks, and all others."""

    def of(digits: Column) -> Column:
        ahead = F.substr(digits, F.lit(1), F.length(digits) - 10)
        core = F.substr(digits, F.length(digits) - 9)
        area, exchange, line = _number(core, 1, 3), _number(core, 4, 3), _number(core, 7, 4)
        value = ((area - 200) * 800 + exchange - 200) * 10_000 + line
        odd = F.when(area < 200, area * 1_000 + exchange).otherwise(200_000 + (area - 200) * 200 + exchange)

        def usual(pair: Column) -> Column:
            new = pair["left"] * 80_000 + pair["right"]
            rest = new % 8_000_000
            return F.concat(_padded(F.floor(new / 8_000_000) + 200, 3), _padded(F.floor(rest / 10_000) + 200, 3), _padded(rest % 10_000, 4))

        def unusual(pair: Column) -> Column:
            more = pair["left"] - 200_000
            late = F.concat(_padded(F.floor(more / 200) + 200, 3), _padded(more % 200, 3))
            return F.concat(F.when(more < 0, _padded(pair["left"], 6)).otherwise(late), _padded(pair["right"], 4))

        told = F.when((area >= 200) & (exchange >= 200), bound(permuted(key, "phone", F.floor(value / 80_000), value % 80_000, (80_000, 80_000)), usual))
        told = told.otherwise(bound(permuted(key, "odd phone", odd, line, (360_000, 10_000)), unusual))
        return bound(told, lambda new: _refilled(text, F.concat(ahead, new)))

    return bound(_digits(text), of)


def _social(key: str, text: Column) -> Column:
    def of(digits: Column) -> Column:
        area, group, serial = _number(digits, 1, 3), _number(digits, 4, 2), _number(digits, 6, 4)
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        left = area - F.when(area > 666, 2).otherwise(1)

        def told(pair: Column) -> Column:
            new = pair["left"] + F.when(pair["left"] >= 665, 2).otherwise(1)
            return F.concat(_padded(new, 3), _padded(F.floor(pair["right"] / 9_999) + 1, 2), _padded(pair["right"] % 9_999 + 1, 4))

        new = permuted(key, "social", left, (group - 1) * 9_999 + serial - 1, (898, 99 * 9_999))
        return F.when(valid, bound(new, lambda pair: _refilled(text, told(pair))))

    return bound(_digits(text), of)


def _address(key: str, text: Column) -> Column:
    def of(parts: Column) -> Column:
        valid = F.forall(parts, lambda x: x <= 255)

        def told(pair: Column) -> Column:
            halves = [part for side in ("left", "right") for part in (F.floor(pair[side] / 256), pair[side] % 256)]
            return F.concat_ws(".", *[half.cast("string") for half in halves])

        new = permuted(key, "address", parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], (65_536, 65_536))
        return F.when(valid, bound(new, told))

    return bound(F.transform(F.split(text, r"\."), lambda x: x.cast("long")), of)


def _date(key: str, text: Column, places: tuple[int, int, int], written) -> Column:
    """A date of which ``places`` name year, month and day among its numbers."""

    def of(parts: Column) -> Column:
        year, month, day = (parts[i].cast("int") for i in places)
        leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
        longest = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
        valid = year.between(1600, 2399) & month.between(1, 12) & day.between(1, longest)
        start = F.lit(FIRST_DAY).cast("date")

        def told(number: Column) -> Column:
            new = permuted(key, "date", F.floor(number / DAYS[1]), number % DAYS[1], DAYS)
            return bound(new, lambda pair: written(F.date_add(start, (pair["left"] * DAYS[1] + pair["right"]).cast("int")), parts))

        return F.when(valid, bound(F.date_diff(F.make_date(year, month, day), start), told))

    return bound(F.split(text, "[-/.]"), of)


def _same_width(value: Column, like: Column) -> Column:
    """A number of a date with a leading 0 where the old one was as wide."""
    return F.when(F.length(like) == 2, F.lpad(value.cast("string"), 2, "0")).otherwise(value.cast("string"))


def pseudonym(found: Column, key: str) -> Column:
    """What replaces a match of ``ANY``; itself if its number or date is not valid."""

    def slashes(day: Column, parts: Column) -> Column:
        return F.concat_ws("/", _same_width(F.month(day), parts[0]), _same_width(F.dayofmonth(day), parts[1]), F.year(day).cast("string"))

    def dots(day: Column, parts: Column) -> Column:
        return F.concat_ws(".", _same_width(F.dayofmonth(day), parts[0]), _same_width(F.month(day), parts[1]), F.year(day).cast("string"))

    local = F.substring_index(found, "@", 1)
    email = F.concat(permuted_text(key, "email", local), F.substr(found, F.length(local) + 1))
    year_first = _date(key, found, (0, 1, 2), lambda day, _: _refilled(found, F.date_format(day, "yyyyMMdd")))
    new = (
        F.when(F.contains(found, F.lit("@")), email)
        .when(F.rlike(found, F.lit(_whole(ADDRESS))), _address(key, found))
        .when(F.rlike(found, F.lit(_whole(YEAR_FIRST))), year_first)
        .when(F.rlike(found, F.lit(r"^\d{1,2}/\d{1,2}/\d{4}$")), _date(key, found, (2, 0, 1), slashes))
        .when(F.rlike(found, F.lit(r"^\d{1,2}\.\d{1,2}\.\d{4}$")), _date(key, found, (2, 1, 0), dots))
        .when(F.rlike(found, F.lit(_whole(SOCIAL))), _social(key, found))
        .when(F.rlike(found, F.lit(_whole(PHONE))), _phone(key, found))
    )
    return F.coalesce(new, found)


def pseudonymised(documents: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """All rows and columns, the text with pseudonyms, plus ``n_found, n_replaced``.

    ``n_found`` counts what looks like a personal value, ``n_replaced`` what was
    valid and changed. A card is 13 to 19 digits that begin and end at a space, a
    hyphen or the end of a run of digits. Dates are y-m-d, m/d/y or d.m.y. Null texts stay null with
    0; empty ones stay empty; repeated rows stay repeated. Columns of those names
    are replaced. The key is part of the query plan, so keep plans as safe as it.
    """
    names = [c for c in documents.columns if c not in ("n_found", "n_replaced")]

    text = F.col(f"_row.{text_column}")

    def of(found: Column) -> Column:
        def joined(new: Column, gaps: Column) -> Column:
            told = F.array_join(F.zip_with(gaps["text"], new, lambda gap, value: F.concat(gap, F.coalesce(value, F.lit("")))), "")
            changed = F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x)) + _total(gaps["n_replaced"])
            n_found = F.size(found) + _total(gaps["n_found"])
            return F.struct(told.alias("text"), n_found.cast("long").alias("n_found"), changed.cast("long").alias("n_replaced"))

        gaps = F.transform(F.split(text, ANY, -1), lambda gap: _without_cards(key, gap))
        new = F.transform(found, lambda value: pseudonym(value, key))
        return F.when(text.isNotNull(), bound(gaps, lambda gaps: bound(new, lambda new: joined(new, gaps))))

    held = documents.select(F.struct(*names).alias("_row")).withColumn("_new", bound(F.regexp_extract_all(text, F.lit(ANY), 0), of))
    columns = [F.coalesce("_new.text", text).alias(c) if c == text_column else F.col(f"_row.{c}") for c in names]
    return held.select(*columns, *[F.coalesce(f"_new.{c}", F.lit(0)).alias(c) for c in ("n_found", "n_replaced")])
