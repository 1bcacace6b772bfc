"""Surrogates for personal data, by DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, kept

#: Kinds in the order in which they are tried at a place, with their Java patterns. Every repeated group has an
#: upper bound (for host names the mail standard's own: 63 characters a label, 127 labels), as Java's matcher takes
#: stack for each round of such a group; unbounded are only runs of single characters, which take none.
KINDS: dict[str, str] = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){0,126}\.[A-Za-z]{2,63}",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_])(?i:password|passwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?(?=[+/_.~-]*[A-Za-z0-9])[A-Za-z0-9+/_.~-]{8,}[\"']?",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\w+])[3-6]\d{3}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}(?!\w)",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\w)|(?<![\w+])\+\d{8,15}(?!\w)",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Herr|Frau|Monsieur|Madame|Señor|Señora|Господин|Госпожа)\.? \p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+){0,2}",
}
#: What every entity holds at least: a quick look before the patterns.
SIGNS = "[0-9@=:]"
KEYS = ("AKIA", "ASIA")
TITLES = ("Mr", "Ms", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Господин", "Госпожа")
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
TITLE = r"^(\p{L}+\.? )"
FEMALE = r"^(?:Mrs|Ms|Frau|Madame|Señora|Госпожа)"
GIVEN = {
    "latin_f": "Ada Clara Edith Emma Greta Helen Ines Julia Laura Lena Marta Nora Olga Paula Rosa Vera",
    "latin_m": "Adam Bruno David Emil Felix Hugo Ivan Jonas Karl Leon Marco Oscar Pablo Ralph Simon Viktor",
    "cyrillic_f": "Анна Вера Галина Дарья Елена Зоя Инна Ксения Лидия Мария Нина Ольга Полина Раиса Софья Юлия",
    "cyrillic_m": "Антон Борис Вадим Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей",
}
SYLLABLES = {
    "latin": "ba bel cor dan del far gan hol kes lan mar mor nes nor pal per quin ras ren ros sal ser tal tor ul val ver vin wes wil yor zan",
    "cyrillic": "ба бел вор дан дел жар ган хол кес лан мар мор нес нор пал пер кин рас рен рос сал сер тал тор ул вал вер вин вес вил йор зан",
}


def kind_of(value: Column) -> Column:
    """The first kind whose pattern the whole value matches."""
    return F.coalesce(*[F.when(value.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in KINDS.items()])


def canonical(kind: Column, value: Column) -> Column:
    """What all mentions of one entity have in common: letters without case, digits without format, no title."""
    key = F.regexp_replace(value, r"^(?i:password|passwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?|[\"']$", "")
    sex = F.when(value.rlike(FEMALE), F.lit("f ")).otherwise(F.lit("m "))
    return (
        F.when(kind == "email", F.lower(value))
        .when(kind.isin("card", "phone", "ssn"), F.regexp_replace(value, r"\D", ""))
        .when(kind == "iban", F.regexp_replace(value, " ", ""))
        .when(kind == "secret", key)
        .when(kind == "name", F.concat(sex, F.regexp_replace(value, TITLE, "")))
        .otherwise(value)
    )


def _byte(digest: Column, i: Column | int) -> Column:
    """Byte i of a hex digest, round and round."""
    i = F.lit(i) if isinstance(i, int) else i
    return F.conv(F.substring(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _shaped(value: Column, digest: Column, skip: int = 0) -> Column:
    """Each letter and digit replaced by another of its script, case and kind; all else, and the first `skip`, stay."""
    hexes = value.rlike("^[0-9a-f]*$")

    def one(ch: Column, i: Column) -> Column:
        b = _byte(F.sha2(F.concat(digest, F.floor(i / 32).cast("string")), 256), i.cast("int"))
        pick = lambda letters: F.substring(F.lit(letters), b % len(letters) + 1, F.lit(1))
        return (
            F.when(i < skip, ch)
            .when(ch.rlike("[0-9]"), pick("0123456789"))
            .when(hexes & ch.rlike("[a-f]"), pick("abcdef"))
            .when(ch.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(ch.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(ch.rlike(r"[а-яё]"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(ch.rlike(r"[А-ЯЁ]"), pick("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"))
            .otherwise(ch)
        )

    return F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), one), "")


def _luhn(digits: Column) -> Column:
    """The digits, the last one made the check digit of the others."""
    body = F.substring(digits, 1, 15)
    each = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.concat(body, ((10 - F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10) % 10).cast("string"))


def _name(canon: Column, digest: Column, longer: Column) -> Column:
    """As many name words of the same gender and script; the family has four syllables and `longer` more."""
    more = F.sequence(F.lit(0), longer)
    words = F.split(F.substring(canon, F.lit(3), F.length(canon)), " ")
    script = F.when(canon.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    sex = F.substring(canon, 1, 1)

    def pick(lists: dict[str, str], which: Column, b: Column) -> Column:
        return F.coalesce(*[F.when(which == k, F.element_at(F.array(*map(F.lit, x.split())), b % len(x.split()) + 1)) for k, x in lists.items()])

    def one(_: Column, i: Column) -> Column:
        i = i.cast("int")
        family = F.initcap(F.concat(*[pick(SYLLABLES, script, _byte(digest, i * 5 + k)) for k in range(1, 5)], F.array_join(F.transform(F.filter(more, lambda k: k > 0), lambda k: pick(SYLLABLES, script, _byte(F.sha2(digest, 256), k))), "")))
        return F.when(i == F.size(words) - 1, family).otherwise(pick(GIVEN, F.concat(script, F.lit("_"), sex), _byte(digest, i * 5)))

    return F.array_join(F.transform(words, one), " ")


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The keyed replacement of a canonical value, of its kind and format.

    E-mail users, secrets and keys grow by a letter, families by a syllable and numbers by a digit with every
    third attempt, so that no kind runs out of surrogates; cards and IP addresses keep their length (10^14 and
    4 * 10^9 values).
    """
    more = F.floor(attempt / 3).cast("int")
    longer, digits = F.repeat(F.lit("a"), more), F.repeat(F.lit("0"), more)
    inner = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 256)
    digest = F.sha2(F.concat(F.lit(key), inner), 256)
    octet = [(_byte(digest, k) % 254 + 1).cast("string") for k in range(4)]
    at = F.instr(canon, "@")
    return (
        F.when(kind == "email", F.concat(_shaped(F.concat(F.substring(canon, F.lit(1), at - 1), longer), digest), F.lit("@"), _shaped(F.regexp_extract(canon, r"@([^.]+)", 1), F.sha2(digest, 256)), F.lit(".example")))
        .when(kind == "card", _luhn(_shaped(canon, digest, 1)))
        .when(kind == "ip", F.concat_ws(".", *octet))
        .when(kind == "access_key", _shaped(F.concat(canon, F.upper(longer)), digest, 4))
        .when(kind == "iban", _shaped(F.concat(canon, digits), digest, 2))
        .when(kind == "phone", _shaped(F.concat(canon, digits), digest, 1))
        .when(kind == "name", _name(canon, digest, more))
        .when(kind == "secret", _shaped(F.concat(canon, longer), digest))
        .otherwise(_shaped(F.concat(canon, digits), digest))
    )


def formatted(kind: Column, value: Column, made: Column) -> Column:
    """The surrogate in the format of one mention: its case, its separators, its title or its keyword."""
    slot = F.when(kind == "iban", F.lit("[A-Z0-9]")).otherwise(F.lit("[0-9]"))
    start = F.struct(F.lit("").alias("o"), F.lit(1).alias("i"))
    step = lambda a, ch: F.when(F.regexp_like(ch, slot), F.struct(F.concat(a["o"], F.substring(made, a["i"], F.lit(1))).alias("o"), (a["i"] + 1).alias("i"))).otherwise(F.struct(F.concat(a["o"], ch).alias("o"), a["i"].alias("i")))
    rest = lambda a: F.concat(a["o"], F.substring(made, a["i"], F.length(made)))
    spaced = F.aggregate(F.filter(F.split(value, ""), lambda c: c != ""), start, step, rest)
    alone = F.size(F.split(F.regexp_replace(value, TITLE, ""), " ")) == 1
    head = F.regexp_extract(value, r"^((?i:password|passwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?)", 1)
    return (
        F.when(kind.isin("card", "phone", "ssn", "iban"), spaced)
        .when((kind == "email") & (value == F.upper(value)), F.upper(made))
        .when(kind == "secret", F.concat(head, made, F.regexp_extract(value, r"([\"']?)$", 1)))
        .when(kind == "name", F.concat(F.regexp_extract(value, TITLE, 1), F.when(alone, _last(made)).otherwise(made)))
        .otherwise(made)
    )


def _last(words: Column) -> Column:
    return F.element_at(F.split(words, " "), -1)


def entity_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, made) for distinct (kind, canon): no two entities of a kind share a surrogate, and none
    is another entity's real value; names are told apart by their families. Those that collide, but for the
    least of each, are made anew, with longer values from attempt to attempt, until none is left."""
    e = kept(entities.distinct().select("kind", "canon", F.lit(0).alias("attempt")), "entities")
    told = lambda c: F.when(F.col("kind") == "name", _last(F.col(c))).otherwise(F.col(c))
    while True:
        made = kept(e.select("kind", "canon", "attempt", surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key).alias("made")).withColumn("told", told("made")), "surrogates")
        twice = made.groupBy("kind", "told").agg(F.min("canon").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        real = e.select("kind", told("canon").alias("told")).distinct().withColumn("first", F.lit(None).cast("string"))
        real = made.select("kind", "told").distinct().join(real, ["kind", "told"])
        bad = kept(twice.select("kind", "told", "first").union(real).groupBy("kind", "told").agg(F.min(F.coalesce("first", F.lit(""))).alias("first")), "collisions")
        if bad.isEmpty():
            return made.drop("attempt", "told")
        again = made.join(bad, ["kind", "told"], "left").withColumn("more", (F.col("first").isNotNull() & (F.col("canon") != F.col("first"))).cast("int"))
        done, e = (e, made, bad), kept(again.select("kind", "canon", (F.col("attempt") + F.col("more")).alias("attempt")), "entities")
        forget(*done)


def resolved(mentions: DataFrame) -> DataFrame:
    """Mentions (uid, pos, value, kind, canon) in which a family alone stands for the one full name of that
    gender and family in the same text; where two fit, or none, it stays an entity of its own."""
    parts = F.split("canon", " ")
    m = mentions.withColumn("sex", F.substring("canon", 1, 1)).withColumn("family", F.element_at(parts, -1)).withColumn("size", F.when(F.col("kind") == "name", F.size(parts)))
    full = m.where("size > 2").groupBy("uid", "sex", "family").agg(F.min("canon").alias("full"), F.max("canon").alias("other")).where("full = other").drop("other")
    alone = m.where("size = 2").join(full, ["uid", "sex", "family"], "left").withColumn("canon", F.coalesce("full", "canon"))
    cols = ["uid", "pos", "value", "kind", "canon"]
    return m.where("size is null or size <> 2").select(cols).union(alone.select(cols))


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The rows with their entities replaced in text_col, and pii_count, the number of replacements.

    Each entity gets one keyed surrogate in all rows and formats, of its kind; names keep title, gender,
    script and number of words, numbers their separators, cards their check digit. A family alone ("Mr
    Smith") becomes that of the full name in the same text, where only one fits. See entity_surrogates for
    distinctness. Rows without entities pass through a narrow filter; only the rows
    that hold some meet the table of surrogates, by a join that splits frequent entities.

    Null texts stay null and, as empty ones, count 0. Very long texts are matched whole, in time that follows
    their length and without deep recursion. Where several kinds match at a place, the first of KINDS is
    taken. Repeated rows each return a row. Other columns stay as they are, whatever their names but
    pii_count, which is replaced. An empty table returns no rows.
    """
    cols = [c for c in docs.columns if c != "pii_count"]
    base = docs.select(*[docs[c] for c in cols])
    sign = base[text_col].rlike(SIGNS)
    for word in (*KEYS, *TITLES):
        sign = sign | base[text_col].contains(word)
    hit = F.coalesce(F.when(sign, base[text_col].rlike(PATTERN)).otherwise(F.lit(False)), F.lit(False))
    row = F.struct(*[base[c] for c in cols])
    rows = base.where(hit).select(row.alias("row"), base[text_col].alias("text"), F.monotonically_increasing_id().alias("uid"))
    rows = kept(rows.select("uid", "row", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("found"), F.split("text", PATTERN, -1).alias("between")), "rows")
    m = rows.select("uid", F.posexplode("found").alias("pos", "value")).withColumn("kind", kind_of(F.col("value")))
    m = m.withColumn("kind", F.coalesce("kind", F.lit("other"))).withColumn("canon", canonical(F.col("kind"), F.col("value")))
    m = kept(resolved(kept(m, "found")), "mentions")
    made = entity_surrogates(m.select("kind", "canon"), key)
    new = m.join(made, ["kind", "canon"]).select("uid", "pos", formatted(F.col("kind"), F.col("value"), F.col("made")).alias("new"))
    new = new.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("pos", "new"))).alias("new"))
    text = F.array_join(F.flatten(F.zip_with("between", F.concat("new.new", F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")
    done = rows.join(new, "uid").select(*[text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in cols], F.size("new").alias("pii_count"))
    return base.where(~hit).select(*[base[c] for c in cols], F.lit(0).alias("pii_count")).unionByName(done)
