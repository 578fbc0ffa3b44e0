"""PII: surrogate generation with SQL functions only.

Entities are found by one pattern.  Each is replaced by a surrogate of its type, format,
script and gender that a keyed one-way digest of the entity gives: letters and digits of
the digest fill its form, check digits are made valid, addresses stay in their class,
given names come from a list of the same gender and script.  Spellings of one entity
(cases of an e-mail address, separators of a number) have one canonical form, so the same entity has
the same surrogate in every document, without a shared table.

Distinctness is checked over all distinct entities: where two would share a surrogate,
or one would be its own, all but the least try again with another digest; those that
did are a table that is joined to the texts that hold them.

The key is a secret and not part of this package: an argument, or what secret_key()
gives.  Without it surrogates can be neither made nor followed back.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import scratch
from .common import cut, join_checked, partitions, shared_dir, stored

#: Setting of a session that holds the key.
KEY_SETTING = "spark.metapep.surrogates.key"

# Given names by gender and script; a known name becomes another of its row.
GIVEN = (
    ("Anna", "Clara", "Emma", "Julia", "Laura", "Maria", "Nina", "Sara", "Sophie", "Eva", "Marta"),
    ("Adam", "Carlos", "David", "Jakob", "Louis", "Martin", "Oscar", "Paul", "Peter", "Simon", "Thomas"),
    ("Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга"),
    ("Борис", "Виктор", "Иван", "Олег", "Павел", "Роман", "Федор"),
    ("Άννα", "Ελένη", "Μαρία", "Σοφία", "Ειρήνη"),
    ("Γιώργος", "Νίκος", "Πέτρος", "Παύλος", "Κώστας"),
)
# Titles before names.
_TITLES = "Mr|Mrs|Ms|Miss|Dr|Herr|Frau|Señora|Señor|Monsieur|Madame|Mme|г-н|г-жа|Κύριος|Κυρία"
# Patterns of the entities; none starts inside a word or number, which one look back decides for all.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_FAMILY = r"\p{Lu}[\p{Ll}'\-]++"
PATTERNS = {
    "email": r"(?<![._%+\-])[\p{L}\p{N}._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "secret": r"(?:(?=[0-9a-fA-F])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}+)(?![\p{L}\p{N}])",
    "ip": rf"(?=\d)(?<!\.){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\d]|\.\d)",
    "phone": r"(?=[+(\d])(?:(?:\+\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)|\+\d{1,3}(?:[ .\-]?\d{2,4}){2,4}(?!\d)|(?<![.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\p{L}\d]|[.\-]\d))",
    "ssn": r"(?=\d)(?<!-)\d{3}-\d{2}-\d{4}(?![\p{L}\d]|-\d)",
    "iban": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])",
    "card": r"(?=\d)(?:\d{13,19}|\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{1,7})(?![\p{L}\d])",
    "name": rf"(?=[A-ZА-ЯΆ-Ώг])(?:(?:{_TITLES})\.? {_FAMILY}(?: {_FAMILY})?|(?:{'|'.join(x for row in GIVEN for x in row)}) {_FAMILY})",
}
_START = r"(?<![\p{L}\p{N}])"
PATTERN = f"{_START}(?:{'|'.join(PATTERNS.values())})"
#: For texts without @, and for those without digits too: what else they can hold.
_NO_MAIL = f"{_START}(?:{'|'.join(x for k, x in PATTERNS.items() if k != 'email')})"
_NO_DIGIT = f"(?=[A-ZА-ЯΆ-Ώгagsf])(?:{PATTERNS['secret']}|{PATTERNS['name']})"

# Alphabets that characters stay in.
_DIGITS, _SMALL, _LARGE = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (
    _DIGITS,
    _SMALL,
    _LARGE,
    "àáâãäåçèéêëìíîïñòóôõöùúûüýšžčćőűřěůł",
    "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝŠŽČĆŐŰŘĚŮŁ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "αβγδεζηθικλμνξοπρστυφχψωάέήίόύώ",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩΆΈΉΊΌΎΏ",
    "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "אבגדהוזחטיכלמנסעפצקרשת",
    "的一是不了人我在有他这中大来上国个到说们张李王刘陈杨赵黄周吴伟芳娜敏静",
    "あいうえおかきくけこさしすせそたちつてと",
    "アイウエオカキクケコサシスセソタチツテト",
    "가나다라마바사아자차카타파하김이박최정",
)
#: For names and hexadecimal secrets: vowels and consonants stay what they are, and digits and letters hexadecimal.
SPOKEN = (
    "aeiouy", "bcdfghjklmnpqrstvwxz", "AEIOUY", "BCDFGHJKLMNPQRSTVWXZ",
    "àáâäåèéêëìíîïòóôöùúûü", "ÀÁÂÄÅÈÉÊÒÓÔÖÙÚÛÜ", "çñšžčćřł", "ÇÑŠŽČĆŘŁ",
    "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕИОУЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
    "αεηιουωάέήίόύώ", "βγδζθκλμνξπρστφχψς", "ΑΕΗΙΟΥΩΆΈΉΊΌΎΏ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
)
HEX = (_DIGITS, "abcdef", "ABCDEF")
#: First numbers of public addresses.
_PUBLIC = [n for n in range(1, 224) if n not in (10, 127, 169, 172, 192)]


def secret_key(spark: SparkSession) -> str:
    """The session's key; where none is set, one made at random, kept in a file of the shared folder, so that later runs there agree."""
    if key := spark.conf.get(KEY_SETTING, None):
        return key
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/surrogates.key")
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        own = jvm.org.apache.hadoop.fs.Path(f"{path.toString()}.{secrets.token_hex(8)}")
        out = fs.create(own, False)
        out.write(bytearray(secrets.token_hex(32).encode()))
        out.close()
        fs.setPermission(own, jvm.org.apache.hadoop.fs.permission.FsPermission("600"))
        if not fs.rename(own, path):  # another run was first
            fs.delete(own, False)
    with_key = fs.open(path)
    try:
        return bytes(b & 0xFF for b in iter(with_key.read, -1)).decode()
    finally:
        with_key.close()


def _let(value: Column, then) -> Column:
    """then(value), with the value computed once; a lambda's argument is the one name that SQL has inside a row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def kind_of(entity: Column) -> Column:
    out = F.lit("name")
    for k in ("card", "iban", "ssn", "phone", "ip", "secret", "email"):
        out = F.when(entity.rlike(f"^(?:{PATTERNS[k]})$"), k).otherwise(out)
    return out


def canonical(entity: Column, kind: Column) -> Column:
    """What all spellings of an entity have in common."""
    words = F.split(F.regexp_replace(entity, rf"^(?:{_TITLES})\.? ", ""), " ")
    return F.when(kind.isin("card", "phone", "ssn"), _bare(entity)).when(kind.isin("email", "iban"), F.lower(F.replace(entity, F.lit(" ")))).when(kind == "name", F.array_join(words, " ")).otherwise(entity)


def _digest(key: Column, *parts: Column) -> Column:
    """128 hexadecimal digits."""
    return F.sha2(F.concat_ws("|", key, *parts), 512)


def _byte(digest: Column, i) -> Column:
    """The i-th of 126 numbers of 12 bits, from 0, then the same again."""
    return F.conv(F.substring(digest, (F.pmod(F.lit(i) if isinstance(i, int) else i, F.lit(126)) + 1).cast("int"), F.lit(3)), 16, 10).cast("int")


def _drawn(x: Column, digest: Column, i, alphabets: tuple[str, ...]) -> Column:
    """A character of x's alphabet; x itself if it is in none."""
    out = x
    for a in reversed(alphabets):
        out = F.when(F.instr(F.lit(a), x) > 0, F.substring(F.lit(a), _byte(digest, i) % len(a) + 1, F.lit(1))).otherwise(out)
    return out


def _fill(text: Column, digest: Column, alphabets: tuple[str, ...]) -> Column:
    return F.array_join(F.transform(F.split(text, ""), lambda x, i: _drawn(x, digest, i, alphabets)), "")


def _numbers(digest: Column) -> Column:
    """126 decimal digits."""
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(125)), lambda i: (_byte(digest, i) % 10).cast("string")), "")


def _put(form: Column, digits: Column) -> Column:
    """The form with its digits replaced by the given ones, in order."""
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(s: Column, x: Column) -> Column:
        digit = x.between("0", "9")
        return F.struct(F.concat(s["out"], F.when(digit, F.substring(digits, s["k"] + 1, F.lit(1))).otherwise(x)).alias("out"), (s["k"] + digit.cast("int")).alias("k"))

    return F.aggregate(F.split(form, ""), begin, step, lambda s: s["out"])


def luhn(digits: Column) -> Column:
    """The sum that is divisible by ten for a valid card number."""
    n = F.split(F.reverse(digits), "").cast("array<int>")
    worth = F.transform(n, lambda x, i: F.when(i % 2 == 0, x).when(x > 4, 2 * x - 9).otherwise(2 * x))
    return F.aggregate(worth, F.lit(0), lambda s, x: s + x)


def _iban_rest(code: Column) -> Column:
    """A bare IBAN, check digits and all, modulo 97, in pieces of letters as numbers."""
    moved = F.upper(F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4)))
    value = lambda x: F.when(x.between("0", "9"), x.cast("int")).otherwise(F.ascii(x) - 55)
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda s, x: F.when(x.between("0", "9"), (s * 10 + value(x)) % 97).otherwise((s * 100 + value(x)) % 97))


def is_entity(entity: Column, kind: Column) -> Column:
    """Whether what the pattern found is one: card numbers must have a valid check digit."""
    return (kind != "card") | (luhn(_bare(entity)) % 10 == 0)


def _email(entity: Column, digest: Column) -> Column:
    """Domains of examples and top-level domains stay."""
    tail = F.regexp_extract(entity, r"(?i)([.@]example\.(?:com|org|net)|\.[a-z0-9\-]+)$", 1)
    local = F.substring(entity, F.lit(1), F.length(entity) - F.length(tail))
    letters = F.translate(F.substring(digest, 1, 12), "0123456789abcdef", "bcdfghjklmnpqrst")
    filled = _fill(local, digest, ALPHABETS)
    return F.concat(F.when(filled == local, letters).otherwise(filled), tail)


def _secret(entity: Column, digest: Column) -> Column:
    start = F.regexp_extract(entity, r"^(AKIA|gh[pousr]_|sk-)?", 1)
    rest = F.substring(entity, F.length(start) + 1, F.length(entity))
    return F.concat(start, F.when(F.length(start) == 0, _fill(rest, digest, HEX)).otherwise(_fill(rest, digest, ALPHABETS[:3])))


def _ip(entity: Column, digest: Column) -> Column:
    """In the same class: private, loopback, link-local, public, multicast or reserved."""
    n = F.split(entity, r"\.").cast("array<int>")
    a, b = F.element_at(n, 1), F.element_at(n, 2)
    x, y, z, u = (_byte(digest, k) for k in (0, 3, 6, 9))
    byte = lambda v: (v % 256).cast("string")
    first = F.element_at(F.array(*map(F.lit, _PUBLIC)), u % len(_PUBLIC) + 1).cast("string")
    out = F.concat_ws(".", first, byte(x), byte(y), byte(z))
    out = F.when(a.isin(0, 10, 127), F.concat_ws(".", a.cast("string"), byte(x), byte(y), byte(z))).otherwise(out)
    out = F.when(((a == 192) & (b == 168)) | ((a == 169) & (b == 254)), F.concat_ws(".", a.cast("string"), b.cast("string"), byte(x), byte(y))).otherwise(out)
    out = F.when((a == 172) & b.between(16, 31), F.concat_ws(".", F.lit("172"), (16 + u % 16).cast("string"), byte(x), byte(y))).otherwise(out)
    return F.when(a >= 224, F.concat_ws(".", (F.when(a < 240, 224).otherwise(240) + u % 16).cast("string"), byte(x), byte(y), byte(z))).otherwise(out)


def _phone(entity: Column, digest: Column) -> Column:
    """Country codes stay, and the exchange of invented numbers."""
    d = _bare(entity)
    country = F.length(F.regexp_extract(entity, r"^\+(\d{1,3})(?=[ .(\-])", 1))
    invented = (F.length(d) - country == 10) & (F.substring(d, country + 4, F.lit(3)) == "555")

    def put(n: Column) -> Column:
        new = F.when(invented, F.concat(F.substring(n, 1, 3), F.lit("555"), F.substring(n, 7, 4))).otherwise(n)
        return _put(entity, F.concat(F.substring(d, F.lit(1), country), new))

    return _let(_numbers(digest), put)


def _card(entity: Column, digest: Column) -> Column:
    d = _bare(entity)
    body = F.substring(_numbers(digest), F.lit(1), F.length(d) - 1)
    return _put(entity, _let(body, lambda b: F.concat(b, ((10 - luhn(F.concat(b, F.lit("0"))) % 10) % 10).cast("string"))))


def _iban(entity: Column, digest: Column) -> Column:
    """With valid check digits, in the entity's groups."""
    body = _fill(F.substring(F.replace(entity, F.lit(" ")), F.lit(5), F.length(entity)), digest, ALPHABETS[:3])
    land = F.substring(entity, 1, 2)

    def whole(b: Column) -> Column:
        check = F.lpad((98 - _iban_rest(F.concat(land, F.lit("00"), b))).cast("string"), 2, "0")
        return F.concat(land, check, b)

    spaced = F.split(entity, "")
    at = lambda i: F.length(F.replace(F.substring(entity, F.lit(1), i + 1), F.lit(" ")))
    return _let(_let(body, whole), lambda w: F.array_join(F.transform(spaced, lambda x, i: F.when(x == " ", " ").otherwise(F.substring(w, at(i), F.lit(1)))), ""))


def _name(entity: Column, key: Column, step: int) -> Column:
    """Titles stay; given names stay in their gender, scripts are kept; parts of a name have the same surrogate wherever they stand."""
    title = F.regexp_extract(entity, rf"^((?:{_TITLES})\.? )?", 1)
    words = F.split(F.substring(entity, F.length(title) + 1, F.length(entity)), " ")
    spoken = lambda w, tag: _fill(w, _digest(key, F.lit(tag), w), SPOKEN)

    def given(w: Column) -> Column:
        # the last letter, which mostly tells the gender, stays
        new = F.concat(spoken(F.substring(w, F.lit(1), F.length(w) - 1), "given"), F.substring(w, F.length(w), F.lit(1)))
        for row in GIVEN if step == 0 else ():
            names = F.array(*map(F.lit, row))
            place = F.array_position(names, w).cast("int")
            new = F.when(place > 0, F.element_at(names, (place + _byte(_digest(key, F.lit("given"), w), 0) % (len(row) - 1)) % len(row) + 1)).otherwise(new)
        return new

    many = F.size(words) > 1
    family = F.element_at(words, -1)
    return F.concat(title, F.when(many, F.concat(given(F.element_at(words, 1)), F.lit(" "))).otherwise(""), spoken(family, "family"))


def _wide(entity: Column, kind: Column, digest: Column) -> Column:
    """Surrogates of forms that are used up, or have no character to change: of the same type in a form of their own."""
    letters = lambda a: F.translate(F.substring(digest, a, 12), "0123456789abcdef", "bcdfghjklmnpqrst")
    title = F.regexp_extract(entity, rf"^((?:{_TITLES})\.? )?", 1)
    n = F.substring(_numbers(digest), 1, 12)
    phone = F.concat(F.lit("+999"), *[x for a in (1, 5, 9) for x in (F.lit(" "), F.substring(n, a, 4))])
    private = F.concat_ws(".", F.lit("10"), *[(_byte(digest, k) % 256).cast("string") for k in (0, 3, 6)])
    email = F.concat(letters(1), F.regexp_extract(entity, "@.*$", 0))
    return F.when(kind == "email", email).when(kind == "phone", phone).when((kind == "ip") & entity.rlike(r"^(?:10|172|192)\."), private).when(kind == "name", F.concat(title, F.initcap(letters(1)), F.lit(" "), F.initcap(letters(13))))


def _token(entity: Column, kind: Column, digest: Column) -> Column:
    """What is left for an entity of a form without a free member: its kind and 24 letters, for names the title and two words."""
    letters = F.translate(F.substring(digest, 41, 24), "0123456789abcdef", "bcdfghjklmnpqrst")
    return F.when(kind == "name", F.concat(F.regexp_extract(entity, rf"^((?:{_TITLES})\.? )?", 1), F.initcap(letters))).otherwise(F.concat(kind, F.lit("-"), letters))


#: Tries in the entity's own form before the wide one; and before a token of 24 letters, which any number of entities can have.
TRIES, LAST = 4, 24


def surrogate(entity: Column, key: str, step: int = 0) -> Column:
    """The surrogate of the step-th try."""

    def made(kind: Column) -> Column:
        k = F.lit(key if step == 0 else f"{key}/{step}")
        digest = _digest(k, kind, canonical(entity, kind))

        def of(d: Column) -> Column:
            ssn = _put(entity, _numbers(d))
            own = {"email": _email(entity, d), "secret": _secret(entity, d), "ip": _ip(entity, d), "phone": _phone(entity, d), "ssn": ssn, "iban": _iban(entity, d), "card": _card(entity, d)}
            out = _name(entity, k, step)
            for name, value in own.items():
                out = F.when(kind == name, value).otherwise(out)
            if step >= LAST:
                return _token(entity, kind, d)
            return F.coalesce(_wide(entity, kind, d), out) if step >= TRIES else out

        return F.when(is_entity(entity, kind), _let(digest, of)).otherwise(entity)

    return _let(kind_of(entity), made)


def _by_need(text: Column, then, otherwise: Column) -> Column:
    """then(pattern) with the shortest pattern that finds all that the text can hold."""
    plain = F.when(text.rlike(_NO_DIGIT), then(_NO_MAIL)).otherwise(otherwise)
    return F.when(text.contains("@"), then(PATTERN)).when(text.rlike("[0-9]"), then(_NO_MAIL)).otherwise(plain)


def found(text: Column) -> Column:
    """What the pattern finds in a text."""
    return _by_need(text, lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0)), F.lit([]).cast("array<string>"))


def texts_with(docs: DataFrame) -> DataFrame:
    """(text, found) of the distinct texts that hold something, by digest, stored: what the check needs of the documents."""
    rows = docs.select("text", found(docs["text"]).alias("found")).filter("size(found) > 0")
    return stored(rows.select(F.sha2("text", 256).alias("text"), F.array_distinct("found").alias("found")), "entities").distinct()


def _mark(entity: Column, key: str) -> Column:
    """A keyed digest, by which an entity's surrogate is found without the entity being written down."""
    return F.sha2(F.concat(F.lit(f"{key}\u0000"), entity), 256)


def _others(docs: DataFrame, key: str) -> DataFrame | None:
    """(_text, _other): for the texts, by digest, that hold exceptions, a map of these, by keyed digest, to their surrogates; None if there are none.

    The tables of entities that this takes are removed before it returns.
    """
    with scratch(docs.sparkSession):
        texts = texts_with(docs)
        others = exceptions(texts, key, partitions(docs))
        if others is None:
            return None
        own = texts.select(F.col("text").alias("_text"), F.explode("found").alias("e"))
        own = own.withColumn("kind", kind_of(F.col("e"))).withColumn("c", canonical(F.col("e"), F.col("kind")))
        held = join_checked(own, others.select("kind", "c", "step"), ["kind", "c"], "inner")
        steps = others.groupBy("step").agg(F.count("*").alias("n")).orderBy("step").collect()  # a row a try
        value = F.col("e")
        for r in steps:
            value = F.when(F.col("step") == r.step, surrogate(F.col("e"), key, r.step)).otherwise(value)
        pair = F.struct(_mark(F.col("e"), key).alias("e"), value.alias("s"))
        return cut(held.select("_text", pair.alias("x")).groupBy("_text").agg(F.map_from_entries(F.collect_set("x")).alias("_other")))


def exceptions(texts: DataFrame, key: str, parts: int) -> DataFrame | None:
    """(kind, c, step) of the entities that don't have the surrogate of the first try, as it is theirs already or another's; None if there are none.

    What it stores names persons: call it within scratch(), and use its rows there.
    """
    rows = texts.select(F.explode("found").alias("e")).distinct().withColumn("kind", kind_of(F.col("e"))).filter(is_entity(F.col("e"), F.col("kind")))
    rows = rows.withColumn("c", canonical(F.col("e"), F.col("kind"))).groupBy("kind", "c").agg(F.min("e").alias("e")).repartition(parts, "c")
    rows = rows.withColumn("s", surrogate(F.col("e"), key))
    rows = stored(rows.withColumn("cs", canonical(F.col("s"), F.col("kind"))), "surrogates")
    taken = rows.filter("c <> cs").groupBy("kind", "cs").agg(F.min("c").alias("c"))
    left = stored(rows.select("kind", "c", "e").join(taken.select("kind", "c"), ["kind", "c"], "left_anti"), "left")
    done, step = None, 0
    while not left.isEmpty():
        step += 1
        tried = left.withColumn("s", surrogate(F.col("e"), key, step)).withColumn("cs", canonical(F.col("s"), F.col("kind"))).filter("c <> cs")
        tried = stored(tried.groupBy("kind", "cs").agg(F.min(F.struct("c", "e")).alias("x")).select("kind", "cs", "x.*"), "tried")
        held = taken.select("kind", "cs") if done is None else taken.select("kind", "cs").union(done.select("kind", "cs"))
        new = tried.join(join_checked(held, tried.select("kind", "cs"), ["kind", "cs"], "left_semi"), ["kind", "cs"], "left_anti")
        new = new.select("kind", "c", "cs", F.lit(step).alias("step"))
        done = stored(new if done is None else done.union(new), "done")
        left = stored(left.join(done.select("kind", "c"), ["kind", "c"], "left_anti"), "left")
    return done


def pseudonymise(docs: DataFrame, key: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For each row of docs: its `keep` columns, text with the entities replaced in place, and n_entities (int).

    Null texts stay null and empty ones empty, with 0 entities; texts without entities
    stay as they are, byte by byte.  A very long text is one text like any other.
    Repeated rows each have their result, the same one; no rows give no rows.  No entity
    is left in the shared folder, only keyed digests of those that needed another try.  Other
    columns are left out, so their names can't clash.
    """
    if clash := {"text", "n_entities", "_parts", "_text", "_other"} & set(keep):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    if not key:
        raise ValueError("surrogates need a key")
    others = _others(docs, key)
    # gaps and entities in turn, by one run of the pattern; a text that holds the mark itself is taken apart in two
    mark = "\u0001"
    text = F.col("text")
    apart = F.split(_by_need(text, lambda p: F.regexp_replace(text, p, f"{mark}$0{mark}"), text), mark, -1)
    slow = F.flatten(F.zip_with(F.split("text", PATTERN, -1), F.concat(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), F.array(F.lit(""))), lambda g, e: F.array(g, e)))
    parts = F.when(text.contains(mark), F.slice(slow, F.lit(1), F.size(slow) - 1)).otherwise(apart)
    rows = docs.select(*keep, "text", parts.alias("_parts"))
    new = lambda e: surrogate(e, key)
    if others is not None:
        # by text, as rows have no key: the surrogates of its exceptions
        rows = rows.withColumn("_text", F.sha2("text", 256))
        rows = join_checked(rows, others, "_text", "left")
        known = F.col("_other").isNotNull()
        new = lambda e: F.coalesce(F.when(known, F.try_element_at("_other", _mark(e, key))), surrogate(e, key))
    put = F.transform("_parts", lambda x, i: F.when(i % 2 == 1, new(x)).otherwise(x))
    n = F.coalesce(F.size(F.filter("_parts", lambda x, i: (i % 2 == 1) & is_entity(x, kind_of(x)))), F.lit(0))
    return rows.select(*keep, F.when(F.size("_parts") > 1, F.array_join(put, "")).otherwise(F.col("text")).alias("text"), n.alias("n_entities"))
