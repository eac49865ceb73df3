"""Personal data replaced by surrogates: keyed, of the same type and format, distinct, and the same wherever an entity recurs.

Native functions only. One expression finds all entities of a text; the pieces between them stay as they are. Surrogates
are made for what an entity is made of, whatever its spelling: digits, address, given and family name. So they agree across
documents and formats, and a check over all of them gives another one to every part but the first where two would share
theirs. Numbers go through a keyed permutation of all numbers of their form, so that a form cannot run out of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallystrata.sources.scratch import stored

# Patterns, in the order in which they are tried. Public formats of addresses and numbers.
EMAIL = r"(?:(?<![\p{L}0-9._%+-])|\G)[\p{L}0-9._%+-]++@[\p{L}0-9-]+(?:\.[\p{L}0-9-]+)+"
IBAN = r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})|\([0-9]{3}\)|[0-9]{3}(?=[.-]))[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
TITLES = {
    "male": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
    "female": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
    "any": ("Dr", "Prof"),
}
# Names by script and gender. Common given and family names.
NAMES = {
    ("latin", "male"): ("James", "Peter", "Paul", "Martin", "Simon", "Lucas", "David", "Oscar", "Victor", "Hugo"),
    ("latin", "female"): ("Maria", "Anna", "Laura", "Julia", "Clara", "Emma", "Sofia", "Nora", "Irene", "Helena"),
    ("latin", "any"): ("Robin", "Alex", "Kim", "Sascha", "Dominique", "Andrea", "Jean", "Noa", "Charlie", "Sam"),
    ("latin", "family"): ("Walker", "Fischer", "Moreau", "Navarro", "Keller", "Bennett", "Lambert", "Ortega", "Vogel", "Carter"),
    ("cyrillic", "male"): ("Иван", "Пётр", "Сергей", "Павел", "Антон"),
    ("cyrillic", "female"): ("Анна", "Мария", "Елена", "Ольга", "Вера"),
    ("cyrillic", "any"): ("Саша", "Женя", "Валя", "Слава", "Шура"),
    ("cyrillic", "family"): ("Коваленко", "Шевченко", "Бондаренко", "Ткаченко", "Кравченко"),
    ("greek", "male"): ("Νίκος", "Γιώργος", "Πέτρος", "Κώστας", "Σπύρος"),
    ("greek", "female"): ("Μαρία", "Ελένη", "Άννα", "Σοφία", "Ειρήνη"),
    ("greek", "any"): ("Αγαθή", "Άρης", "Χάρις", "Φώτις", "Σάκης"),
    ("greek", "family"): ("Αγγέλου", "Γεωργίου", "Δημητρίου", "Ιωάννου", "Νικολάου"),
}
# Syllables that make names longer, by script.
SYLLABLES = {
    "latin": ("ber", "den", "lis", "mor", "nav", "ros", "tal", "ven", "kor", "zan", "del", "fin", "gar", "hol", "jas", "wen"),
    "cyrillic": ("бер", "ден", "лис", "мор", "нав", "рос", "тал", "вен", "кор", "зан", "дел", "фин", "гар", "хол", "яс", "вил"),
    "greek": ("βερ", "δεν", "λισ", "μορ", "ναβ", "ροσ", "ταλ", "βεν", "κορ", "ζαν", "δελ", "φιν", "γαρ", "χολ", "ιασ", "βιλ"),
}
# Calling codes of countries. The public numbering plan; all others have three digits.
CALLING_CODE = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
#: Kinds whose replacements come from a permutation.
PERMUTED = ("ip", "card", "ssn", "phone", "iban")
SURNAME = r"\p{Lu}[\p{L}'-]+"
TITLE = r"\b(?=\p{Lu})(?:" + "|".join(t for group in TITLES.values() for t in group) + r")\.? "
NAME = TITLE + SURNAME + "(?: " + SURNAME + ")?"
KINDS = {"email": EMAIL, "iban": IBAN, "ip": IP, "card": CARD, "ssn": SSN, "phone": PHONE, "name": NAME}
#: What every entity has; texts without it need no further search.
HINT = "[0-9@]|" + TITLE
#: Within a word only a number can begin, or what follows another entity; this spares most places the seven patterns.
ENTITY = r"(?:(?<![A-Za-z])|(?=[0-9+(])|\G)(?:" + "|".join(f"(?:{p})" for p in KINDS.values()) + ")"
#: Put around entities to cut a text; a noncharacter of Unicode. Texts that hold it are searched twice instead.
MARK = "\uffff"


def kind(entity: Column) -> Column:
    """Type of a found entity: the first pattern that it is wholly of."""
    pairs = [(name, entity.rlike(f"^(?:{pattern})$")) for name, pattern in KINDS.items()]
    return reduce(lambda rest, p: F.when(p[1], p[0]).otherwise(rest), reversed(pairs), F.lit("name"))


def _draw(secret: str, entity: Column, turn: Column, label: str) -> Column:
    """64 hex digits that only the holder of the secret can tell."""
    return F.sha2(F.concat_ws("\n", F.lit(secret), F.lit(label), turn.cast("string"), entity), 256)


def _number(stream: Column, at: Column | int, below: int) -> Column:
    """A number below ``below`` from four hex digits of the stream."""
    begin = (F.lit(at) if isinstance(at, int) else at) * 4
    digits = F.substring(stream, (begin % 60 + 1).cast("int"), F.lit(4))
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(below))


def _shaped(value: Column, stream: Column) -> Column:
    """Each digit by a digit, each letter by a letter of its case, the rest as it is.

    Characters of another script become letters of that script's own range.
    """
    chars = F.split(value, "")

    def one(c, i):
        long_stream = F.sha2(F.concat(stream, F.floor(i / 15).cast("string")), 256)
        n = F.pmod(F.conv(F.substring(long_stream, (i % 15 * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("bigint"), F.lit(2600)).cast("int")
        pick = lambda letters: F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"\p{IsCyrillic}"), F.when(c.rlike(r"\p{Lu}"), pick("АБВГДЕЖЗИКЛМНОПРСТУФ")).otherwise(pick("абвгдежзиклмнопрстуф")))
            .when(c.rlike(r"\p{IsGreek}"), F.when(c.rlike(r"\p{Lu}"), pick("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦ")).otherwise(pick("αβγδεζηθικλμνξοπρστυφ")))
            .when(c.rlike(r"\p{Lu}"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(c.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz"))
            .otherwise(c)
        )

    return F.array_join(F.transform(chars, one), "")


def _luhn(body: Column) -> Column:
    """The digit that follows ``body`` so that the Luhn sum is a multiple of ten."""
    digit = lambda c: c.cast("int")
    doubled = lambda c: F.when(digit(c) > 4, digit(c) * 2 - 9).otherwise(digit(c) * 2)
    summands = F.transform(F.split(body, ""), lambda c, i: F.when((F.length(body) - i) % 2 == 1, doubled(c)).otherwise(digit(c)))
    return F.pmod(-F.aggregate(summands, F.lit(0), lambda total, x: total + x), F.lit(10))


def _placed(pattern: Column, symbols: Column, places: str) -> Column:
    """``pattern`` with the characters that match ``places`` replaced by ``symbols``, one after the other."""
    before = lambda i: F.length(F.regexp_replace(F.substring(pattern, F.lit(1), i + 1), f"[^{places}]", ""))
    return F.array_join(
        F.transform(F.split(pattern, ""), lambda c, i: F.when(c.rlike(f"[{places}]"), F.substring(symbols, before(i), F.lit(1))).otherwise(c)), ""
    )


def _permute(table: DataFrame, secret: str) -> DataFrame:
    """Adds ``_digits``: a keyed permutation of the numbers of one kind, prefix and length, as a Feistel network of four rounds.

    Being a permutation, it gives different numbers to different ones however many of them there are.
    """
    body = F.col("_body")
    half = F.floor(F.length(body) / 2).cast("int")
    is_ip = F.col("kind") == "ip"
    octet = lambda k: F.element_at(F.split("canon", r"\."), k).cast("bigint")
    below = lambda n: F.when(is_ip, F.lit(65536)).otherwise(F.pow(F.lit(10.0), n)).cast("bigint")
    out = table.withColumns({
        "_left": F.when(is_ip, octet(1) * 256 + octet(2)).otherwise(F.substring(body, F.lit(1), half).try_cast("bigint")),
        "_right": F.when(is_ip, octet(3) * 256 + octet(4)).otherwise(F.substring(body, half + 1, F.length(body)).try_cast("bigint")),
        "_m": below(half), "_n": below(F.length(body) - half),
    })
    for k in range(4):
        one, other, size = ("_left", "_right", "_m") if k % 2 == 0 else ("_right", "_left", "_n")
        seed = F.concat_ws("\n", "kind", "_prefix", F.length(body).cast("string"), F.col(other).cast("string"))
        drawn = F.conv(F.substring(_draw(secret, seed, F.col("turn"), f"round {k}"), 1, 14), 16, 10).cast("bigint")
        out = out.withColumn(one, F.pmod(F.col(one) + F.pmod(drawn, F.col(size)), F.col(size)))
    left, right = F.col("_left"), F.col("_right")
    octets = F.concat_ws(".", *[x.cast("bigint").cast("string") for c in (left, right) for x in (F.floor(c / 256), c % 256)])
    digits = F.concat(F.lpad(left.cast("string"), half, F.lit("0")), F.lpad(right.cast("string"), F.length(body) - half, F.lit("0")))
    return out.withColumn("_digits", F.when(is_ip, octets).otherwise(digits)).drop("_left", "_right", "_m", "_n")


def _choose(names: tuple[str, ...], stream: Column, at: int) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (_number(stream, at, len(names)) + 1).cast("int"))


def _name(stream: Column, turn: Column) -> Column:
    """A lower-case name of the part's script and gender; longer with each turn."""
    def pick(which):
        out = F.lit(None).cast("string")
        for (script, gender), names in NAMES.items():
            if (gender == "family") == (which == "family"):
                out = F.when((F.col("script") == script) & (F.lit(True) if gender == "family" else F.col("gender") == gender), _choose(names, stream, 0)).otherwise(out)
        return out

    # Family names get three syllables of the stream, as a list of names alone could not keep many entities apart, and one
    # more with each turn, so that there are sixteen times as many for those that still share theirs. Given names get
    # syllables from the second turn on.
    tail = lambda names, n: F.array_join(
        F.transform(F.sequence(F.lit(0), n), lambda k: F.when(k == 0, "").otherwise(_choose(names, F.sha2(F.concat_ws("\n", stream, k.cast("string")), 256), 0))), ""
    )
    n = F.when(F.col("kind") == "family", turn + 3).otherwise(turn)
    tails = reduce(lambda rest, s: F.when(F.col("script") == s, tail(SYLLABLES[s], n)).otherwise(rest), SYLLABLES, F.lit(""))
    return F.lower(F.concat(F.when(F.col("kind") == "family", pick("family")).otherwise(pick("given")), tails))


def parts(entity: Column) -> Column:
    """What an entity is made of, as an array of ``kind, canon, gender, script``: spellings of one thing have equal parts.

    Numbers are compared by their digits (and a leading plus), accounts without blanks, addresses and names without regard
    to case, names apart from their title and family names apart from given names.
    """
    found = kind(entity)
    names = F.split(F.lower(F.regexp_extract(entity, r"^\S+ (.*)$", 1)), " ")
    bare = F.regexp_replace(F.regexp_extract(entity, r"^(\S+) ", 1), r"\.$", "")
    gender = F.when(bare.isin(*TITLES["male"]), "male").when(bare.isin(*TITLES["female"]), "female")
    script = lambda c: F.when(c.rlike(r"\p{IsCyrillic}"), "cyrillic").when(c.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    part = lambda k, canon, g=None: F.struct(
        (k if isinstance(k, Column) else F.lit(k)).alias("kind"), canon.alias("canon"), (F.lit(None).cast("string") if g is None else g).alias("gender"), script(canon).alias("script")
    )
    family = part("family", F.element_at(names, -1))
    canon = (
        F.when(found == "email", F.lower(entity)).when(found == "ip", entity).when(found == "iban", F.replace(entity, F.lit(" ")))
        .otherwise(F.concat(F.regexp_extract(entity, r"^\+?", 0), F.regexp_replace(entity, "[^0-9]", "")))
    )
    return F.when(found != "name", F.array(part(found, canon))).when(F.size(names) > 1, F.array(part("given", names[0], gender), family)).otherwise(F.array(family))


def cores(table: DataFrame, secret: str) -> DataFrame:
    """``table`` (``kind, canon, gender, script, turn``) with ``core``, the replacement of ``canon``; another turn gives another one."""
    canon, turn = F.col("canon"), F.col("turn")
    is_ = lambda *kinds: F.col("kind").isin(*kinds)
    stream = _draw(secret, F.concat_ws("\n", "kind", "canon"), turn, "surrogate")
    host = F.substring(_draw(secret, F.regexp_extract(canon, "@(.*)$", 1), turn, "domain"), 1, 10)
    email = F.concat(_shaped(F.regexp_extract(canon, "^([^@]*)@", 1), stream), F.lit("@host"), host, F.lit(".example.org"))
    # Codes of countries keep their places; the last digit of a card follows from the others and from whether it was right.
    prefix = F.when(is_("phone"), F.regexp_extract(canon, rf"^(?:\+(?:{CALLING_CODE}))?", 0)).when(is_("iban"), F.substring(canon, 1, 2)).otherwise("")
    digits = F.regexp_replace(F.substring(canon, F.length("_prefix") + 1, F.length(canon)), "[^0-9]", "")
    table = table.withColumn("_prefix", prefix).withColumn("_body", F.when(is_("card"), F.substring(canon, 1, 15)).when(is_("ip"), "").otherwise(digits))
    table = _permute(table, secret)
    off = F.substring(canon, 16, 1).cast("int") - _luhn(F.col("_body"))
    card = F.concat("_digits", F.pmod(_luhn(F.col("_digits")) + off, F.lit(10)).cast("string"))
    # Letters of an account move along the alphabet by what the new digits say, which keeps different accounts different.
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    moved = lambda c, i: F.pmod(F.ascii(c) - 65 + _number(_draw(secret, F.concat_ws("\n", "_prefix", "_digits"), i, "letter"), 0, 26), F.lit(26))
    rest = F.substring(canon, F.length("_prefix") + 1, F.length(canon))
    lettered = F.array_join(
        F.transform(F.split(rest, ""), lambda c, i: F.when(c.rlike("[A-Z]"), F.substring(F.lit(letters), moved(c, i).cast("int") + 1, F.lit(1))).otherwise(c)), ""
    )
    core = (
        F.when(is_("family", "given"), _name(stream, turn)).when(is_("email"), email).when(is_("ip"), F.col("_digits")).when(is_("card"), card)
        .when(is_("iban"), F.concat("_prefix", _placed(lettered, F.col("_digits"), "0-9"))).otherwise(F.concat("_prefix", "_digits"))
    )
    return table.withColumn("core", core).drop("_prefix", "_body", "_digits")


def distinct_cores(listed: DataFrame, secret: str, rounds: int = 20) -> DataFrame:
    """``kind, canon, core`` for the distinct parts of ``listed``: no two of one kind share a core, and none is a part itself.

    Each round checks all of them: of those that share one the smallest part keeps it, the others and whatever equals a part
    draw anew, names and addresses from a space that grows with each round. Numbers of fixed length have none that grows: a
    kind of them that is still not settled after ``rounds`` goes back to its first draw, a permutation, where no two share
    one, but a core may be the number of someone else.
    """
    # Drawing costs far more than the few bytes of a part suggest. Asked for by another expression than the grouping's own
    # keys, the exchange stays one of its own, which adaptive execution does not merge.
    tasks = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = listed.groupBy("kind", "canon", "script").agg(F.min("gender").alias("least"), F.max("gender").alias("most"))
    # A given name has the gender that all titles before it agree on.
    gender = F.when(F.col("least") == F.col("most"), F.col("least")).otherwise("any")
    table = table.select("kind", "canon", gender.alias("gender"), "script").repartition(tasks, F.xxhash64("kind", "canon"))
    table = stored(cores(table.withColumn("turn", F.lit(0)), secret), "cores")
    settled: list[str] = []
    done = 0
    while True:
        owner = table.filter(~F.col("kind").isin(*settled)) if settled else table
        owner = owner.groupBy("kind", "core").agg(F.min("canon").alias("owner"), F.count("*").alias("n"))
        taken = table.select("kind", F.col("canon").alias("core"), F.lit(True).alias("taken"))
        # Owners of a core that nobody else has and that is no part stay as they are.
        wrong = stored(owner.join(taken, ["kind", "core"], "left").filter("n > 1 or taken").select(
            "kind", "core", F.when(F.col("taken"), None).otherwise(F.col("owner")).alias("owner")
        ), "wrong")
        if wrong.isEmpty():
            return table.select("kind", "canon", "core")
        done += 1
        if done > rounds:
            fixed = [r["kind"] for r in wrong.select("kind").distinct().collect() if r["kind"] in PERMUTED]
            if fixed:
                settled += fixed
                first = table.filter(F.col("kind").isin(*fixed) & (F.col("turn") > 0)).withColumn("turn", F.lit(0))
                table = stored(table.filter(~F.col("kind").isin(*fixed) | (F.col("turn") == 0)).unionByName(cores(first.drop("core"), secret)), "cores")
                continue
        moved = table.join(wrong, ["kind", "core"]).filter(~F.col("canon").eqNullSafe(F.col("owner"))).drop("core", "owner").withColumn("turn", F.col("turn") + 1)
        kept = table.join(moved.select("kind", "canon"), ["kind", "canon"], "left_anti")
        table = stored(kept.unionByName(cores(moved, secret)), "cores")


def _rendered(entity: Column, entity_kind: Column, core: Column, given: Column) -> Column:
    """The cores of an entity's parts in the format of this mention: its separators, its title, its case."""
    title, names = F.regexp_extract(entity, r"^(\S+) ", 1), F.split(F.regexp_extract(entity, r"^\S+ (.*)$", 1), " ")
    cased = lambda new, old: F.when((old == F.upper(old)) & (F.length(old) > 1), F.upper(new)).otherwise(F.initcap(new))
    name = F.concat_ws(" ", title, F.when(F.size(names) > 1, cased(given, names[0])), cased(core, F.element_at(names, -1)))
    local = F.regexp_extract(core, "^([^@]*)@", 1)
    is_upper = lambda i: F.substring(entity, i + 1, F.lit(1)).rlike(r"\p{Lu}")
    email = F.concat(F.array_join(F.transform(F.split(local, ""), lambda c, i: F.when(is_upper(i), F.upper(c)).otherwise(c)), ""), F.regexp_extract(core, "@.*$", 0))
    return (
        F.when(entity_kind == "name", name).when(entity_kind == "email", email).when(entity_kind == "ip", core)
        .when(entity_kind == "iban", _placed(entity, core, "A-Z0-9")).otherwise(_placed(entity, F.regexp_replace(core, "[^0-9]", ""), "0-9"))
    )


def surrogates(entities: DataFrame, secret: str, rounds: int = 20) -> DataFrame:
    """``entity, kind, surrogate`` for distinct ``entity`` values: different entities have different surrogates, spellings of
    one entity the same one in their own format, and none is an entity itself (see :func:`distinct_cores` for the one exception)."""
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mentions = entities.select("entity").distinct().repartition(tasks, F.xxhash64("entity"))
    mentions = stored(mentions.select("entity", kind(F.col("entity")).alias("kind"), parts(F.col("entity")).alias("parts")), "mentions")
    known = distinct_cores(mentions.select(F.inline("parts")), secret, rounds)
    one = mentions.select("entity", F.col("kind").alias("whole"), F.inline("parts")).drop("gender", "script").join(known, ["kind", "canon"])
    both = one.groupBy("entity", "whole").agg(F.max(F.when(F.col("kind") != "given", F.col("core"))).alias("core"), F.max(F.when(F.col("kind") == "given", F.col("core"))).alias("given"))
    return both.select("entity", F.col("whole").alias("kind"), _rendered(F.col("entity"), F.col("whole"), F.col("core"), F.col("given")).alias("surrogate"))


def _pieces(text: Column) -> Column:
    """The text cut around its entities: what precedes the first, the first, what follows it, and so on; null for null."""
    marked = F.split(F.regexp_replace(text, ENTITY, f"{MARK}$0{MARK}"), MARK, -1)
    found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    zipped = F.flatten(F.zip_with(F.split(text, ENTITY, -1), found, lambda p, e: F.array(p, F.coalesce(e, F.lit("")))))
    return F.when(text.rlike(HINT), F.when(text.contains(MARK), zipped).otherwise(marked)).when(text.isNotNull(), F.array(text))


def _is_entity(piece: Column, i: Column) -> Column:
    return (i % 2 == 1) & (piece != "")


def pseudonymise(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` rewritten and ``n_entities``, the number of replaced places; null stays null, with 0.

    E-mail addresses, IBANs, IPv4 addresses, card, social-security and telephone numbers, and names after a title are
    replaced. Spellings of one entity have the same surrogate in all rows, each in its own format. A column of ``docs`` named ``n_entities`` is replaced.
    The texts are searched once and stored in pieces, as the search is the costly part.
    """
    docs = docs.drop("n_entities")
    others = [c for c in docs.columns if c != text]
    carried = [F.struct(*others).alias("_row")] if others else []
    cut = docs.select(*carried, F.col(text).alias("_text"), _pieces(F.col(text)).alias("_pieces"))
    entities = F.filter("_pieces", _is_entity)
    cut = cut.select(*[c for c in cut.columns if c != "_text"], F.sha2("_text", 256).alias("_key"), F.coalesce(F.size(entities), F.lit(0)).cast("bigint").alias("_n"))
    cut = stored(cut, "pieces")

    def finished(rows: DataFrame, rewritten: Column) -> DataFrame:
        return rows.select(*[rewritten.alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns], F.col("_n").alias("n_entities"))

    plain, held = cut.filter("_n <= 0"), cut.filter("_n > 0")
    listed = held.select("_key", F.explode(F.array_distinct(entities)).alias("entity")).distinct()
    known = surrogates(listed, secret)
    maps = listed.join(known, "entity").groupBy("_key").agg(
        F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("_map")
    )
    replaced = F.transform("_pieces", lambda p, i: F.when(_is_entity(p, i), F.element_at("_map", p)).otherwise(p))
    return finished(plain, F.array_join("_pieces", "")).unionByName(finished(held.join(maps, "_key"), F.array_join(replaced, "")))
