"""PII surrogates, in DataFrame functions only.

Entities are found by one expression (e-mail, card, social security number,
phone, IP address of both versions, IBAN, secret in hexadecimal or a provider's
key format, titled name).  Each distinct entity
gets one keyed surrogate of its own kind: digits stay digits and separators stay
where they are, a card keeps its first digit and a valid check digit, an IBAN
its country and valid check digits, an address
keeps valid octets, an e-mail keeps the shape of its local part, a key its
prefix and letter cases, a name keeps
gender (from the title) and script.  A mention is an entity in some form
("(487) 555-7209" and "+1 (487) 555-7209" are one phone), so equal entities have
equal surrogates everywhere (coreference); a word of a titled name is the same
entity wherever its text has it again without the title.  An IBAN whose check
digits are wrong is none, and stays.

Distinctness: a surrogate is taken by one entity only, the least in order, and
never equals an entity of the corpus; the losers are keyed again with the next
attempt until none is left.  Only distinct entities go through this.  A hot
entity is a hot join key, which adaptive execution can split; the texts of rows
without entities are never shuffled.

Every repetition of a group in the expressions is bounded, so that matching
needs no deep stack on any text.

Defined results: a null text stays null, an empty one empty, with 0 entities;
repeated rows are treated each; an empty table gives an empty result; all
columns of the input are carried along, whatever their names (one that is
called ``__pii`` is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm._scratch import Scratch

# Titles by script and gender, and given names to choose from.
MALE, FEMALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "господин"], ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа"]
GIVEN = {
    "given_m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Martin", "Noel", "Oscar", "Paul"],
    "given_f": ["Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Hanna", "Irene", "Julia", "Klara", "Laura", "Maria", "Nora", "Olga", "Paula"],
    "given_m_cyr": ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Семён", "Тимур"],
    "given_f_cyr": ["Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Инна", "Клара", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "София"],
}
SYLLABLES = {"": ["ba", "de", "fo", "gi", "ha", "ke", "lo", "mi", "na", "pe", "ro", "si", "ta", "ve", "wo", "zu"], "_cyr": ["ба", "де", "фо", "ги", "ха", "ке", "ло", "ми", "на", "пе", "ро", "си", "та", "ве", "го", "зу"]}

_title = "|".join([*MALE, *FEMALE])
_HEX = "[0-9A-Fa-f]{1,4}"
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}@(?:[A-Za-z0-9\-]{1,63}\.){1,16}[A-Za-z]{2,24}"
CARD = r"(?<!\d)\d{4}(?:[ \-]?\d{4}){3}(?!\d)"
SSN = r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"
PHONE = r"(?<!\d)(?:\+1[ .\-]?)?(?:\(\d{3}\)[ .\-]?|\d{3}[.\-])\d{3}[ .\-]\d{4}(?!\d)"
#: an international number has 7 to 15 digits
ABROAD = r"(?<![\d+])\+(?=(?:[ .\-()]{0,2}\d){7,15}(?![ .\-]?\d))[1-9]\d{0,3}(?:[ .\-]?\(?\d{1,12}\)?){1,6}(?!\d)"
IP = r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?\d)"
#: global, local and unique addresses: all eight groups, or fewer and a double colon
IP6 = rf"(?<![0-9A-Za-z:.])(?:[23][0-9A-Fa-f]{{3}}|[Ff][EeCcDd][0-9A-Fa-f]{{2}})(?:(?::{_HEX}){{7}}|(?=[0-9A-Fa-f:]{{0,34}}::)(?:::?{_HEX}){{1,6}}(?:::)?)(?![0-9A-Za-z:])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
SECRET = r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])"
# Prefixes of the key formats of well-known providers.
KEY = r"(?<![0-9A-Za-z_])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z_\-]{20,120}|xox[abprs]-[0-9A-Za-z\-]{10,120}|AIza[0-9A-Za-z_\-]{35}|eyJ[0-9A-Za-z_\-]{10,400}\.[0-9A-Za-z_\-]{10,800}\.[0-9A-Za-z_\-]{10,400})(?![0-9A-Za-z_])"
NAME = rf"(?<!\p{{L}})(?:{_title})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?(?!\p{{L}})"
ANY = "|".join((EMAIL, KEY, SECRET, IBAN, CARD, SSN, PHONE, ABROAD, IP, IP6, NAME))
#: in a text with a titled name any capitalised word may be one of its parts
WORD = r"(?<!\p{L})\p{Lu}\p{L}+(?!\p{L})"
#: anything with an entity has one of these
HINT = rf"[0-9@]|eyJ|xox|sk-|gh[pousr]_|(?:{_title})\.? \p{{Lu}}"
#: letters of the keyed surrogates by hexadecimal digit
LETTERS = "kbdfghlmnprstvaz"


def _one_of(values: list[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (at + 1).cast("int"))


def kind_of(mention: Column) -> Column:
    return (
        F.when(mention.contains("@"), "email").when(mention.rlike(f"^(?:{KEY})$"), "key").when(mention.rlike(r"^[0-9A-Fa-f]{32,64}$"), "secret")
        .when(mention.rlike(r"^[A-Z]{2}\d{2} ?[A-Z0-9]{4} ?[A-Z0-9]{4}"), F.when(_mod97(mention) == 1, "iban").otherwise("none"))
        .when(mention.rlike(r"^\d{4}(?:[ \-]?\d{4}){3}$"), "card").when(mention.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(mention.rlike(r"^\d+(?:\.\d+){3}$"), "ip")
        .when(mention.contains(":"), "ip6").when(mention.rlike(r"^\p{L}+$"), "word").when(mention.rlike(r"^\p{L}"), "name")
        .when(mention.startswith("+") & ~_digits(mention).rlike(r"^1\d{10}$"), "abroad").otherwise("phone")
    )


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _mod97(iban: Column) -> Column:
    """An IBAN's number modulo 97: the first four characters go last, a letter is 10 to 35.  1 if it is valid."""
    x = F.upper(F.translate(iban, " ", ""))
    turned = F.split(F.concat(F.substring(x, F.lit(5), F.length(x)), F.substring(x, 1, 4)), "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(turned, F.lit(0), lambda s, c: (s * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)


def parts_of(mention: Column) -> Column:
    """The entities of a mention: (before, kind, canonical, form); one, or two for a full name."""
    kind = kind_of(mention)
    canonical = (
        F.when(kind.isin("card", "ssn", "abroad"), _digits(mention)).when(kind == "phone", F.right(_digits(mention), F.lit(10)))
        .when(kind == "iban", F.translate(mention, " ", "")).when(kind == "key", mention).otherwise(F.lower(mention))
    )
    whole = F.array(F.struct(F.lit("").alias("before"), kind.alias("kind"), canonical.alias("canonical"), mention.alias("form")))
    word = F.split(mention, " ")
    script = F.when(mention.rlike(r"\p{IsCyrillic}"), "_cyr").otherwise("")
    gender = F.when(F.regexp_replace(word[0], r"\.", "").isin(MALE), "given_m").otherwise("given_f")
    last = F.element_at(word, -1)
    surname = F.struct(F.when(F.size(word) == 3, " ").otherwise(F.concat(word[0], F.lit(" "))).alias("before"), F.concat(F.lit("surname"), script).alias("kind"), F.lower(last).alias("canonical"), last.alias("form"))
    given = F.struct(F.concat(word[0], F.lit(" ")).alias("before"), F.concat(gender, script).alias("kind"), F.lower(word[1]).alias("canonical"), word[1].alias("form"))
    return F.when(kind != "name", whole).when(F.size(word) == 3, F.array(given, surname)).otherwise(F.array(surname))


def _luhn(digits: Column) -> Column:
    """Sum of the check over all digits but the last, whose value completes it to a multiple of ten."""
    n = F.length(digits)
    at = F.sequence(F.lit(1), n - 1)
    value = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    twice = lambda i: F.when((n - i) % 2 == 1, F.when(value(i) > 4, value(i) * 2 - 9).otherwise(value(i) * 2)).otherwise(value(i))
    return F.aggregate(at, F.lit(0), lambda s, i: s + twice(i))


def _shaped(x: Column, digits: Column, letters: Column, kept: int = 0) -> Column:
    """Each letter and digit of ``x`` after the first ``kept`` characters replaced by the stream's, letter case kept."""
    at = lambda stream, i: F.substring(stream, i + 1, F.lit(1))
    out = F.transform(F.split(x, ""), lambda c, i: F.when(i < kept, c).when(c.rlike("[a-z]"), at(letters, i)).when(c.rlike("[A-Z]"), F.upper(at(letters, i))).when(c.rlike("[0-9]"), at(digits, i)).otherwise(c))
    return F.array_join(out, "")


MOST_ATTEMPTS = 100


def surrogate(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """The canonical form of an entity's surrogate at some attempt."""
    seed = F.concat_ws("|", F.lit(key), kind, canonical, attempt.cast("string"))
    h = F.sha2(seed, 256)
    letter = lambda x: F.translate(x, "0123456789abcdef", LETTERS)
    digits, letters = F.translate(h, "abcdef", "048263"), letter(h)
    number = lambda start, n: F.conv(F.substring(h, start, n), 16, 10).cast("int")
    body = F.concat(F.substring(canonical, 1, 1), F.substring(digits, 1, 14))
    valid = (_luhn(canonical) + F.right(canonical, F.lit(1)).cast("int")) % 10 == 0
    check = F.when(valid, F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")).otherwise(F.substring(digits, 16, 1))
    ip = F.concat_ws(".", *((number(1 + 4 * i, 4) % (223 if i == 0 else 256) + (1 if i == 0 else 0)).cast("string") for i in range(4)))
    local, domain = F.substring_index(canonical, "@", 1), F.substring_index(canonical, "@", -1)
    shaped = _shaped(local, F.concat(digits, digits), F.concat(letters, letters))
    shaped = F.when(attempt == 0, shaped).otherwise(F.concat(shaped, F.right(letters, F.lit(4))))
    host = F.concat(letter(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain), 256), 1, 8)), F.lit(".example.org"))
    # an address keeps its first two digits, which say of what sort it is
    ip6 = F.array_join(F.transform(F.split(canonical, ""), lambda c, i: F.when((i < 2) | (c == ":"), c).otherwise(F.substring(h, i + 1, F.lit(1)))), "")
    account = _shaped(F.substring(canonical, F.lit(5), F.length(canonical)), digits, letters)
    blank = F.concat(F.substring(canonical, 1, 2), F.lit("00"), account)
    iban = F.concat(F.substring(canonical, 1, 2), F.lpad((F.lit(98) - _mod97(blank)).cast("string"), 2, "0"), account)
    # a number keeps its first two digits, a country's; where the numbers of one run short, one and then none
    country = F.when(attempt < 8, 2).when(attempt < 16, 1).otherwise(0)
    # a stream as long as the longest key
    long = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(canonical) / 64).cast("int")), lambda i: F.sha2(F.concat_ws("|", seed, i.cast("string")), 256)), "")
    token = _shaped(canonical, F.translate(long, "abcdef", "048263"), letter(long), kept=4)
    out = (
        F.when(kind == "email", F.concat(shaped, F.lit("@"), host)).when(kind == "card", F.concat(body, check)).when(kind == "ssn", F.substring(digits, 1, 9))
        .when(kind == "phone", F.concat((number(1, 2) % 8 + 2).cast("string"), F.substring(digits, 3, 9))).when(kind == "abroad", F.concat(F.substring(canonical, F.lit(1), country), F.substring(digits, F.lit(1), F.length(canonical) - country)))
        .when(kind == "ip", ip).when(kind == "ip6", ip6).when(kind == "iban", iban).when(kind == "key", token).when(kind == "secret", F.substring(h, F.lit(1), F.length(canonical)))
    )
    for script, syllables in SYLLABLES.items():
        # a syllable more with each attempt, so that the values never run out (a digest has 64 digits)
        tail = F.array_join(F.transform(F.sequence(F.lit(1), F.least(attempt + 4, F.lit(64))), lambda i: _one_of(syllables, F.conv(F.substring(h, i, F.lit(1)), 16, 10).cast("int"))), "")
        out = out.when(kind == f"surname{script}", tail)
        for gender in ("given_m", "given_f"):
            # one name, then two, then one and syllables
            first, second = (F.lower(_one_of(GIVEN[gender + script], number(k, 1))) for k in (9, 10))
            out = out.when(kind == gender + script, F.when(attempt == 0, first).otherwise(F.concat(first, F.lit("-"), F.when(attempt == 1, second).otherwise(tail))))
    return out


def rendered(kind: Column, form: Column, surrogate: Column) -> Column:
    """A surrogate in the form of a mention: its digits in the mention's places, or its letter case (of names, and of what is all upper case)."""
    n = F.length(_digits(form)) - F.length(surrogate)
    count = lambda i: F.length(_digits(F.substring(form, F.lit(1), i + 1)))  # noqa: E731  digits up to the i-th character
    placed = F.array_join(F.transform(F.split(form, ""), lambda c, i: F.when(c.rlike("[0-9]") & (count(i) > n), F.substring(surrogate, count(i) - n, F.lit(1))).otherwise(c)), "")
    grouped = F.array_join(F.transform(F.split(form, ""), lambda c, i: F.when(c == " ", c).otherwise(F.substring(surrogate, i + 1 - F.length(F.regexp_replace(F.substring(form, F.lit(1), i), "[^ ]", "")), F.lit(1)))), "")
    return F.when(kind.isin("card", "ssn", "phone", "abroad"), placed).when(kind == "iban", grouped).when(kind == "key", surrogate).when(kind.startswith("surname") | kind.startswith("given"), F.initcap(surrogate)).when((form == F.upper(form)) & (form != F.lower(form)), F.upper(surrogate)).otherwise(surrogate)


def assign(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, canonical, surrogate): distinct, and never an entity of the table itself."""
    pending = scratch.keep(entities.select("kind", "canonical").distinct().withColumn("attempt", F.lit(0)), "entities")
    originals = pending.select("kind", F.col("canonical").alias("surrogate"))
    done = None
    for step in range(MOST_ATTEMPTS):
        tried = pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("canonical"), F.col("attempt"), key))
        free = tried.join(originals, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        winner = free.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        winner = scratch.keep(winner.select("kind", "canonical", "surrogate"), f"given-{step}")
        left = pending.join(winner, ["kind", "canonical"], "left_anti").withColumn("attempt", F.col("attempt") + 1)
        left = scratch.keep(left, f"pending-{step}")
        done = winner if done is None else done.unionByName(winner)
        if left.isEmpty():
            return done
        pending = left
    raise ValueError(f"after {MOST_ATTEMPTS} attempts there are entities without a surrogate: more of a kind than it has values")


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` and a struct ``__pii`` (text, n_entities, kinds)."""
    scratch = Scratch(docs.sparkSession, "pii")
    columns = [c for c in docs.columns if c != "__pii"]
    # the input's columns travel in one struct, so that no name of theirs meets one of ours
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("r"), F.col(f"`{text_col}`").cast("string").alias("text"))
    some = rows.withColumn("first", F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))))
    named = F.exists("first", lambda m: m.rlike(f"^(?:{NAME})$"))
    both = f"{ANY}|{WORD}"
    hit = some.where(F.size("first") > 0).select(
        "r", F.when(named, F.regexp_extract_all("text", F.lit(both), F.lit(0))).otherwise(F.col("first")).alias("mentions"),
        F.when(named, F.split("text", both, -1)).otherwise(F.split("text", ANY, -1)).alias("gaps"), F.monotonically_increasing_id().alias("row"),
    )
    hit = scratch.keep(hit, "found")  # once written, the row numbers are fixed
    mention = hit.select("row", F.posexplode("mentions").alias("pos", "mention"))
    part = mention.select("row", "pos", F.posexplode(parts_of(F.col("mention"))).alias("part", "p")).select("row", "pos", "part", "p.*").where("kind <> 'none'")
    part = scratch.keep(part, "parts")
    titled = part.where("kind <> 'word'")
    # words without a title are the names that the same text has with one
    known = titled.where("kind like 'given%' or kind like 'surname%'").groupBy("row", "canonical").agg(F.min("kind").alias("kind"))
    again = part.where("kind = 'word'").drop("kind").join(known, ["row", "canonical"])
    names = assign(titled, key, scratch)
    out = titled.unionByName(again).join(names, ["kind", "canonical"])
    out = out.select("row", "kind", F.struct("pos", "part", F.concat("before", rendered(F.col("kind"), F.col("form"), F.col("surrogate"))).alias("out")).alias("one"))
    whole = out.groupBy("row").agg(F.collect_list("one").alias("new"), F.array_sort(F.collect_set("kind")).alias("kinds"))
    empty = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    done = hit.join(whole, "row", "left").withColumn("new", empty("new", "array<struct<pos:int,part:int,out:string>>")).withColumn("at", F.array_distinct(F.transform("new", lambda x: x["pos"])))
    # the gaps, the mentions that stay, and what stands for the others, in one list by position
    gaps = F.transform("gaps", lambda g, i: F.struct(i.alias("pos"), F.lit(-1).alias("part"), g.alias("out")))
    left = F.array_except(F.transform("mentions", lambda m, i: i), F.col("at"))
    left = F.transform(left, lambda i: F.struct(i.alias("pos"), F.lit(0).alias("part"), F.get("mentions", i).alias("out")))
    new = F.array_join(F.transform(F.array_sort(F.concat(gaps, left, F.col("new"))), lambda x: x["out"]), "")
    done = done.select("r", F.struct(new.alias("text"), F.size("at").alias("n_entities"), empty(F.col("kinds"), "array<string>").alias("kinds")).alias("__pii"))
    none = F.struct(F.col("text"), F.lit(0).alias("n_entities"), F.array().cast("array<string>").alias("kinds"))
    rest = some.where(F.coalesce(F.size("first"), F.lit(0)) <= 0).select("r", none.alias("__pii"))
    return done.unionByName(rest).select(*(F.col(f"r.`{c}`") for c in columns), "__pii")
