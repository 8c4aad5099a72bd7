"""Deterministic masks as native column expressions: null stays null, equal inputs give equal outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: letters of national and company ids
DNI = "TRWAGMYFPDXBNJZSQVHLCKE"
CIF_TYPES = "ABCDEFGHJKLMNPQRSUVW"
CIF_LETTERS = "JABCDEFGHI"
# this library's own words
MARKER = "MASKED TEXT"
STREETS = ["TERRACE", "LANE", "WHARF", "CRESCENT"]
NAMES = ["ELM", "OAK", "RIVER", "HILL", "GARDEN", "STATION", "MARKET", "BRIDGE"]
CITIES = ["NORTHFIELD", "SOUTHPORT", "EASTON", "WESTBURY", "LAKEVIEW", "STONEHAM", "GREENDALE", "FAIRHAVEN"]


def seed(salt: str, x: Column) -> Column:
    """1 to 2147483646, from the MD5 of salt and value."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt + "|"), F.substring(x, 1, 1000))), 1, 7), 16, 10).cast("long") % 2147483646 + 1


# letters by a recurrence on the seed, seed' = (131 seed + 17) mod 26; as 131 is 1 modulo 26, the k-th is (seed + 17 k) mod 26,
# which runs round one cycle from the place 23 seed on: 23 is the inverse of 17
CYCLE = "".join(chr(65 + 17 * k % 26) for k in range(26)) * 40


def mix_alpha(x: Column, s: Column) -> Column:
    """Letters become others by the recurrence, of which a run of them takes a part; the rest stays."""
    runs = F.regexp_extract_all(F.substring(x, 1, 1000), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    start = F.struct(F.lit("").alias("out"), ((s * 23 + 1) % 26).cast("int").alias("at"))

    def step(acc: Column, run: Column) -> Column:
        letters, n = run.rlike(r"^\p{L}"), F.length(run)
        return F.struct(F.concat(acc["out"], F.when(letters, F.substr(F.lit(CYCLE), acc["at"] + 1, n)).otherwise(run)).alias("out"), F.when(letters, (acc["at"] + n) % 26).otherwise(acc["at"]).alias("at"))

    return F.aggregate(runs, start, step)["out"]


def name(x: Column) -> Column:
    return mix_alpha(x, seed("NAME", F.upper(x)))


def address(x: Column) -> Column:
    s = seed("ADDRESS", F.upper(x))
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))
    return F.when(x.isNotNull(), F.concat_ws("", pick(STREETS, s), F.lit(" "), pick(NAMES, F.floor(s / 4)), F.lit(" N "), (F.floor(s / 17) % 999 + 1).cast("string"), F.lit(", "), pick(CITIES, F.floor(s / 11))))


def free_text(x: Column) -> Column:
    return F.when(x.isNotNull(), F.lit(MARKER))


def trimmed(x: Column, most: int = 50) -> Column:
    """Upper case without outer blanks; null if nothing is left."""
    return F.nullif(F.upper(F.trim(F.substring(x, 1, most))), F.lit(""))


def digits_of(x: Column, most: int = 1000) -> Column:
    return F.regexp_replace(F.substring(x, 1, most), "[^0-9]", "")


def phone(x: Column) -> Column:
    s = seed("PHONE", digits_of(x))
    return F.concat(F.substr(F.lit("6789"), (s % 4 + 1).cast("int"), F.lit(1)), F.lpad(((s * 97 + 13) % 100000000).cast("string"), 8, "0"))


def email(x: Column) -> Column:
    """Ten letters by the recurrence of ``mix_alpha``; number and domain come from the seed after the tenth."""
    s = seed("EMAIL", F.lower(F.trim(F.substring(x, 1, 1000))))
    user = F.lower(F.substr(F.lit(CYCLE), ((s * 23 + 1) % 26).cast("int") + 1, F.lit(10)))
    last = (s + 170) % 26
    return F.when(x.isNotNull(), F.concat(user, ((last * 31 + 7) % 999).cast("string"), F.when(last % 2 == 0, F.lit("@example.com")).otherwise(F.lit("@example.org"))))


def dni_letter(n: Column) -> Column:
    return F.substr(F.lit(DNI), (n % 23 + 1).cast("int"), F.lit(1))


def cif_control(kind: Column, digits: Column) -> Column:
    """Control of seven digits: odd places doubled with their digits added, even ones as they are; a letter or a digit by type."""
    at = lambda k: F.substring(digits, k, 1).cast("int")
    total = sum((at(k) for k in (2, 4, 6)), F.lit(0))
    for k in (1, 3, 5, 7):
        d = at(k) * 2
        total = total + F.floor(d / 10) + d % 10
    c = ((F.lit(10) - total % 10) % 10).cast("int")
    letter, digit = F.substr(F.lit(CIF_LETTERS), c + 1, F.lit(1)), c.cast("string")
    return F.when(kind.isin(*"KPQSNW"), letter).when(kind.isin(*"ABEH") | (c % 2 == 0), digit).otherwise(letter)


def national_number(s: Column) -> Column:
    n = (s * 37 + 19) % 100000000
    return F.concat(F.lpad(n.cast("string"), 8, "0"), dni_letter(n))


def foreign_number(s: Column) -> Column:
    """X, Y or Z by the seed, which counts as 0, 1 or 2 before the digits in the control letter."""
    kind, m = s % 3, (s * 41 + 23) % 10000000
    return F.concat(F.substr(F.lit("XYZ"), (kind + 1).cast("int"), F.lit(1)), F.lpad(m.cast("string"), 7, "0"), dni_letter(kind * 10000000 + m))


def national_id(x: Column) -> Column:
    u = trimmed(x)
    s = seed("ID", u)
    cif = F.substr(F.lit(CIF_TYPES), (s % 20 + 1).cast("int"), F.lit(1))
    digits = F.lpad(((s * 43 + 29) % 10000000).cast("string"), 7, "0")
    return F.when(u.rlike("^[0-9]{8}[A-Z]$"), national_number(s)).when(u.rlike("^[XYZ][0-9]{7}[A-Z]$"), foreign_number(s)).when(u.isNotNull(), F.concat(cif, digits, cif_control(cif, digits)))


def account(x: Column) -> Column:
    """As many digits as the input has, or else characters, 4 to 20, from a seed of the digits alone."""
    digits = digits_of(x, 200)
    size = F.when(F.length(digits) == 0, F.length(F.substring(x, 1, 200))).otherwise(F.length(digits))
    return F.call_function("lpad", ((seed("ACCOUNT", digits) * 131 + 17) % 1000000000000).cast("string"), F.least(F.greatest(size, F.lit(4)), F.lit(20)), F.lit("0"))


def iban(x: Column, salt: str = "IBAN") -> Column:
    """A valid number, cut to the input's length without blanks if that is shorter."""
    u = F.upper(F.trim(F.substring(x, 1, 50)))
    bban = F.lpad(((seed(salt, u) * 137 + 31) % 1000000000000).cast("string"), 20, "0")
    check = F.lit(98) - (F.concat(bban, F.lit("142800")).cast("decimal(38,0)") % 97).cast("int")
    full = F.concat(F.lit("ES"), F.lpad(check.cast("string"), 2, "0"), bban)
    n = F.length(F.replace(u, F.lit(" "), F.lit("")))
    return F.when(x.isNotNull(), F.when((n > 0) & (n < 24), F.substr(full, F.lit(1), n)).otherwise(full))


def bank(x: Column) -> Column:
    return F.when(F.upper(F.trim(F.substring(x, 1, 50))).rlike("^ES[0-9]{22}$"), iban(x)).otherwise(account(x))


def keep_ends(x: Column) -> Column:
    """First and last characters stay, in upper case without outer blanks; digits and letters between change, the rest stays. Two characters or fewer stay."""
    u = trimmed(x, 4000)
    start = F.struct(F.lit("").alias("out"), seed("ENDS", u).alias("s"))

    def step(acc: Column, c: Column) -> Column:
        digit, letter = (acc["s"] * 29 + 7) % 10, (acc["s"] * 131 + 17) % 26
        isd, isl = c.rlike("^[0-9]$"), c.rlike(r"^\p{L}$")
        out = F.when(isd, digit.cast("string")).when(isl, F.char((letter + 65).cast("int"))).otherwise(c)
        return F.struct(F.concat(acc["out"], out).alias("out"), F.when(isd, digit).when(isl, letter).otherwise(acc["s"]).alias("s"))

    n = F.length(u)
    middle = F.aggregate(F.split(F.substr(u, F.lit(2), n - 2), ""), start, step)["out"]
    return F.when(n <= 2, u).otherwise(F.concat(F.substring(u, 1, 1), middle, F.substr(u, n, F.lit(1))))


def document(x: Column, kind: Column) -> Column:
    """By the document's type: 1 a national number, 3 a foreign one, else the value with nines for digits."""
    u = trimmed(x, 4000)
    s = seed("DOC", F.concat(u, F.lit("|"), F.coalesce(kind.cast("string"), F.lit("-1"))))
    return F.when(u.isNull(), F.lit(None)).when(kind == 1, national_number(s)).when(kind == 3, foreign_number(s)).otherwise(F.regexp_replace(u, "[0-9]", "9"))


EXACT = {"NAME": name, "ADDRESS": address, "PHONE": phone, "EMAIL": email, "NATIONAL_ID": national_id, "ACCOUNT": account, "IBAN": iban, "FREE_TEXT": free_text, "KEEP_ENDS": keep_ends}
LEAST_LENGTH = {"NATIONAL_ID": 8, "PHONE": 7, "EMAIL": 5, "ACCOUNT": 10, "IBAN": 10, "BANK": 10, "NAME": 2, "ADDRESS": 3}


def mask(identifier: str, x: Column) -> Column:
    """The mask for an identifier: exact names first, then names that hold one; free text otherwise."""
    key = identifier.upper()
    if key in EXACT:
        return EXACT[key](x)
    if "BANK" in key:
        return bank(x)
    return next((f for k, f in EXACT.items() if k in key), free_text)(x)


def fit(x: Column, length: int | None) -> Column:
    return x if length is None else F.substring(x, 1, length)


def feistel(n: Column, top: int, key: str, decrypt: bool = False, rounds: int = 6) -> Column:
    """A keyed bijection on [0, top): a balanced Feistel network, walked on while the value is outside.

    At least a quarter of the network's values lie inside, so of 169 steps all are outside for about one value in 10**20; that one gives null, as does a value that isn't in [0, top).
    """
    half = max(1, (max(1, (top - 1).bit_length()) + 1) // 2)
    mask = F.lit((1 << half) - 1)
    keys = F.array(*[F.lit(f"{key}|{r}") for r in (reversed(range(rounds)) if decrypt else range(rounds))])

    def turn(v: Column, k: Column) -> Column:
        left, right = F.shiftright(v, half), v.bitwiseAND(mask)
        if decrypt:
            return F.shiftleft(right.bitwiseXOR(F.xxhash64(k, left).bitwiseAND(mask)), half).bitwiseOR(left)
        return F.shiftleft(right, half).bitwiseOR(left.bitwiseXOR(F.xxhash64(k, right).bitwiseAND(mask)))

    # a value that is still outside is held as its complement, which is negative; every step is worked out once
    def step(v: Column, _: Column) -> Column:
        return F.when(v >= 0, v).otherwise(F.aggregate(keys, F.bitwise_not(v), turn, lambda w: F.when(w < top, w).otherwise(F.bitwise_not(w))))

    def steps(v: Column, _: Column) -> Column:
        return F.when(v >= 0, v).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(13)), v, step))

    def walk(v: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(13)), F.when((v >= 0) & (v < top), F.bitwise_not(v)), steps, lambda w: F.when(w >= 0, w))

    return F.transform(F.array(n.cast("long")), walk)[0]
