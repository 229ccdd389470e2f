"""Surrogates for personal data and secrets, in DataFrame functions only.

One pattern finds all entities; a text is the alternation of the parts
between matches and the matches. Each distinct entity gets a keyed
replacement of its own kind: letters for letters and digits for digits with
all punctuation kept, valid octets for addresses, valid check digits for
cards, names of the title's gender and the name's script.

* Coreference: an entity is its canonical form (digits of a phone or card,
  lower case of an e-mail, a hexadecimal secret or a name's part), so every
  spelling and every document gets the same replacement. A given name after a
  title without a gender is the entity that a gendered title makes of it.
* Later mentions: where a document names somebody by title, every capitalised
  word of that document that equals a part of the name is replaced too.
* Distinctness: replacements that two entities of a kind share, or that equal
  an entity of the corpus, are drawn again for all but the smallest, round by
  round, until none is left. Raises after ``ROUNDS``.

Only distinct entities are joined and grouped; texts without an entity are
never shuffled. A very common entity is one row of the table of entities, and
its occurrences join it by a join that Spark may split.

Defined results: a null text stays null; an empty one stays empty; rows that
repeat an id are treated alike; extra columns pass through; an empty table
gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.llm.lines import computed
from dimloom.llm.own import Own
from dimloom.operators.ids import materialize

ROUNDS = 24
#: From this round on, an address's octets may change their number of digits.
WIDER = 8
#: Titles by gender (fixed values); they count in any case, but for the common word "miss".
FEMALE = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "Г-жа"]
MALE = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Г-н"]
NEUTRAL = ["Doctor", "Dr", "Professor", "Prof"]


def any_title(titles: list[str]) -> str:
    """A pattern of any of the titles."""
    return "(?:(?iu:" + "|".join(t for t in titles if t != "Miss") + ")" + ("|Miss|MISS" if "Miss" in titles else "") + ")"


TITLES = rf"(?:{any_title([*FEMALE, *MALE, *NEUTRAL])}\.? ){{1,3}}"
#: A capitalised word, without a genitive's s.
NAME_WORD = r"\p{Lu}\p{L}*+(?:['’-](?![sS](?!\p{L}))\p{L}++)*+"
SECRET_HEAD = r"(?i:token|secret|password|passwd|api[_-]?key)[\"'`]?\s*+[=:]\s*+"
EMAIL = r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
IP = r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
#: What ends a phone if it begins at one of the phone's groups of digits.
NO_PHONE = rf"{IP}|{EMAIL}|(?<= ){SSN}|(?<= )\d{{3}}-\d{{3}}-\d{{4}}(?!\w)|(?<= )\d{{4}}(?:[ -]\d{{4}}){{3}}(?!\w)"

#: Kinds of which an unquoted secret is none.
OTHERS = {
    "email": EMAIL,
    "key": r"(?<!\w)AKIA[A-Z0-9]{16}(?!\w)",
    "ip": IP,
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?!\w)",
    "phone": r"(?<![\w.])(?:\+(?:1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\d{1,3}[ .-]?\(\d{3}\) ?\d{3}-\d{4})(?!\w|-\d)"
             rf"|\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)|\d{{1,4}})(?:[ .-]?(?!{NO_PHONE})\d{{2,4}}){{1,4}}|\(\d{{3}}\) ?\d{{3}}-\d{{4}}|\d{{3}}-\d{{3}}-\d{{4}})(?!\w)",
    "ssn": SSN,
}
#: Kinds in the order in which the pattern tries them.
PATTERNS = {
    "email": OTHERS["email"],
    "secret": rf"(?<![A-Za-z0-9]){SECRET_HEAD}(?:\"[^\"\n]{{8,}}+\"|'[^'\n]{{8,}}+'|`[^`\n]{{8,}}+`|(?!{'|'.join(OTHERS.values())})[^\s\"'`,;<>(){{}}\[\]]{{7,}}[^\s\"'`,;<>(){{}}\[\].:!?])",
    **{kind: p for kind, p in OTHERS.items() if kind != "email"},
    "name": rf"(?<!\p{{L}}){TITLES}{NAME_WORD}(?: {NAME_WORD})?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Every match of the pattern holds one of these characters or texts, or a match of the last; they are looked for first, being cheap to find.
HINT_CHARACTERS = "[0-9@]"
HINT_TEXTS = ["AKIA"]
HINT_PATTERN = rf"{SECRET_HEAD}|(?<!\p{{L}}){any_title([*FEMALE, *MALE, *NEUTRAL])}\.? \p{{Lu}}"
LATIN = "bcdfglmnprstv aeiou"
CYRILLIC = "бвгдклмнпрст аеиоу"


def kind_of(value: Column) -> Column:
    """The first kind whose pattern matches all of a match."""
    return F.coalesce(*[F.when(value.rlike(rf"\A(?:{p})\z"), kind) for kind, p in PATTERNS.items()], F.lit("other"))


def parts_of(kind: Column, value: Column) -> Column:
    """The canonical entities of a match, as (kind, canon): the parts of a name are entities of their own."""
    digits = F.regexp_replace(value, r"\D", "")
    bare = F.regexp_replace(F.regexp_replace(value, rf"\A{SECRET_HEAD}", ""), r"\A[\"'`]|[\"'`]\z", "")
    bare = F.when(bare.rlike(r"\A[0-9A-Fa-f]+\z"), F.lower(bare)).otherwise(bare)
    titled = lambda titles: F.regexp_extract(value, rf"\A{TITLES}", 0).rlike(rf"(?<!\p{{L}}){any_title(titles)}\.? ")
    words = F.split(F.regexp_replace(value, rf"\A{TITLES}", ""), " ")
    named = F.transform(words, lambda w, i: F.struct(
        F.concat(F.when(i == F.size(words) - 1, "surname").when(titled(FEMALE), "female").when(titled(MALE), "male").otherwise("person"), F.when(w.rlike(r"\A\p{IsCyrillic}"), "-cyrillic").otherwise("-latin")).alias("kind"),
        F.lower(w).alias("canon")))
    canon = (F.when(kind == "email", F.lower(value)).when(kind.isin("card", "phone", "ssn"), digits).when(kind == "secret", bare)
             .when(kind == "iban", F.regexp_replace(value, " ", "")).otherwise(value))
    return F.when(kind == "name", named).otherwise(F.array(F.struct(kind.alias("kind"), canon.alias("canon"))))


def stream(key: str, length: Column) -> Column:
    """Keyed bytes (as an array of ints) for an entity and its round: four or more for every character."""
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(length / 16).cast("int")), lambda b: F.sha2(F.concat_ws("\x1f", F.lit(key), F.col("kind"), F.col("canon"), F.col("round"), b), 256))
    text = F.array_join(blocks, "")
    return F.transform(F.sequence(F.lit(0), F.ceil(length / 16).cast("int") * 16 + 15), lambda i: F.conv(F.substr(text, i * 4 + 1, F.lit(4)), 16, 10).cast("int"))


def pick(alphabet: str, random: Column) -> Column:
    return F.substr(F.lit(alphabet), F.pmod(random, F.lit(len(alphabet))) + 1, F.lit(1))


def like(char: Column, random: Column) -> Column:
    """A character of the same class."""
    return (F.when(char.rlike("[0-9]"), pick("0123456789", random)).when(char.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz", random))
            .when(char.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", random)).when(char.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz", random)).otherwise(char))


def draw(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, round) with ``surrogate``: a replacement of the canonical form."""
    e = computed(entities, "bytes", stream(key, F.length("canon")))
    e = computed(e, "chars", F.filter(F.split("canon", ""), lambda c: c != ""))
    byte = lambda i: F.col("bytes")[i]
    every = lambda f: F.array_join(F.transform("chars", f), "")
    at = F.instr("canon", "@")
    dot = F.length("canon") - F.length(F.substring_index("canon", ".", -1))
    email = every(lambda c, i: F.when((i + 1 > dot) & (i + 1 > at), c).otherwise(like(c, byte(i))))
    hexed = F.col("canon").rlike(r"\A[0-9a-f]+\z")
    secret = F.when(hexed, every(lambda c, i: pick("0123456789abcdef", byte(i)))).otherwise(every(lambda c, i: like(c, byte(i))))
    awskey = every(lambda c, i: F.when(i < 4, c).otherwise(pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", byte(i))))

    def octet(o: Column, i: Column) -> Column:
        wide = (F.pmod(byte(i), F.lit(254)) + 1).cast("string")
        same = F.when(F.length(o) == 1, 1 + F.pmod(byte(i), F.lit(9))).when(F.length(o) == 2, 10 + F.pmod(byte(i), F.lit(90))).otherwise(100 + F.pmod(byte(i), F.lit(155))).cast("string")
        return F.when(F.col("round") >= WIDER, wide).otherwise(same)

    ip = F.array_join(F.transform(F.split("canon", r"\."), octet), ".")
    body = every(lambda c, i: F.when(i == 0, c).when(i == F.length("canon") - 1, "").otherwise(pick("0123456789", byte(i))))
    phone = every(lambda c, i: F.when(i == 0, c).when(i == F.length("canon") - 10, pick("23456789", byte(i))).otherwise(pick("0123456789", byte(i))))
    other = every(lambda c, i: like(c, byte(i)))
    cyrillic = F.col("kind").endswith("cyrillic")

    def syllables(alphabet: str, endings: dict[str, str]) -> Column:
        hard, soft = alphabet.split(" ")
        made = F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.length("canon") / 2 - 1).cast("int")) + F.floor(F.col("round") / 6).cast("int")),
                                        lambda i: F.concat(pick(hard, byte(2 * i)), pick(soft, byte(2 * i + 1)))), "")
        end = F.when(F.col("kind").startswith("female"), endings["female"]).when(F.col("kind").startswith("male"), endings["male"]).when(F.col("kind").startswith("person"), endings["person"]).otherwise(endings["surname"])
        return F.concat(made, end)

    name = F.when(cyrillic, syllables(CYRILLIC, {"female": "на", "male": "н", "person": "ль", "surname": "ко"})).otherwise(syllables(LATIN, {"female": "na", "male": "n", "person": "l", "surname": "son"}))
    kind = F.col("kind")
    e = e.withColumn("body", F.when(kind == "card", body))
    # the check digit makes the weighted sum of all digits a multiple of 10 (every second digit from the right doubled)
    size = F.length("body")
    digit = lambda i: F.substr(F.col("body"), size - i, F.lit(1)).cast("int")
    total = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), lambda s, i: s + F.when(i % 2 == 0, F.when(digit(i) > 4, 2 * digit(i) - 9).otherwise(2 * digit(i))).otherwise(digit(i)))
    card = F.concat("body", F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10)).cast("string"))
    value = (F.when(kind == "email", email).when(kind == "secret", secret).when(kind == "key", awskey).when(kind == "ip", ip).when(kind == "card", card)
             .when(kind.isin("phone", "ssn"), phone).when(kind.rlike("latin|cyrillic"), name).otherwise(other))
    return e.withColumn("surrogate", value).select("kind", "canon", "round", "surrogate")


def distinct_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) with no surrogate twice in a kind, and none equal to an entity of its kind."""
    names = materialize(entities.select("kind", "canon"), "pii-entities")
    table = materialize(draw(names.withColumn("round", F.lit(0)), key), "pii-round")
    for _ in range(ROUNDS):
        holder = table.groupBy("kind", "surrogate").agg(F.min("canon").alias("holder"), F.count(F.lit(1)).alias("n"))
        taken = names.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("taken"))
        clash = holder.join(taken, ["kind", "surrogate"], "left").where("n > 1 or taken").select("kind", "surrogate", F.when(F.col("taken"), F.lit(None)).otherwise(F.col("holder")).alias("holder"))
        judged = materialize(table.join(clash, ["kind", "surrogate"], "left").join(clash.select("kind", "surrogate", F.lit(True).alias("hit")), ["kind", "surrogate"], "left")
                             .withColumn("again", F.col("hit").isNotNull() & ~F.col("canon").eqNullSafe(F.col("holder"))), "pii-judged")
        if not judged.where("again").limit(1).count():
            return table.select("kind", "canon", "surrogate")
        again = draw(judged.where("again").select("kind", "canon", (F.col("round") + 1).alias("round")), key)
        table = materialize(judged.where("not again").select("kind", "canon", "round", "surrogate").union(again), "pii-round")
    raise RuntimeError(f"surrogates still collide after {ROUNDS} rounds")


def with_known_gender(parts: DataFrame) -> DataFrame:
    """``parts`` (value, k, kind, canon), in which a given name of unknown gender has the kind that it has elsewhere."""
    known = parts.where(F.col("kind").rlike("^(fe)?male-")).groupBy("canon").agg(F.min("kind").alias("known"))
    person = F.col("kind").startswith("person-")
    found = parts.where(person).join(known, "canon", "left").withColumn("kind", F.coalesce("known", "kind")).select(*parts.columns)
    return parts.where(~person).unionByName(found)


def cased(word: Column, surrogate: Column) -> Column:
    """A name's surrogate, in capitals where the word is."""
    return F.when((F.length(word) > 1) & (word == F.upper(word)), F.upper(surrogate)).otherwise(F.initcap(surrogate))


def rendered(kind: Column, value: Column, made: Column) -> Column:
    """A match with its canonical parts' surrogates ``made`` (an array) in the match's own format."""
    one = made[0]
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    digits = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[0-9]"), F.substr(one, F.length(F.regexp_replace(F.substr(value, F.lit(1), i + 1), r"\D", "")), F.lit(1))).otherwise(c)), "")
    upper = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.substr(one, i + 1, F.lit(1)))).otherwise(F.substr(one, i + 1, F.lit(1)))), "")
    spaced = F.array_join(F.transform(chars, lambda c, i: F.when(c == " ", c).otherwise(F.substr(one, F.length(F.replace(F.substr(value, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1)))), "")
    titles, words = F.regexp_extract(value, rf"\A{TITLES}", 0), F.split(F.regexp_replace(value, rf"\A{TITLES}", ""), " ")
    named = F.concat(titles, F.array_join(F.transform(made, lambda m, i: cased(words[i], m)), " "))
    head = F.regexp_extract(value, rf"\A{SECRET_HEAD}[\"'`]?", 0)
    hidden = F.substr(value, F.length(head) + 1, F.length(one))
    capital = hidden.rlike(r"\A[0-9A-F]+\z") & hidden.rlike("[A-F]")
    secret = F.concat(head, F.when(capital, F.upper(one)).otherwise(one), F.regexp_extract(value, r"[\"'`]\z", 0))
    return (F.when(kind == "email", upper).when(kind.isin("card", "phone", "ssn"), digits).when(kind == "secret", secret)
            .when(kind == "iban", spaced).when(kind == "name", named).otherwise(one))


def mentions(gap: Column) -> Column:
    """A text between matches, with the words that are parts of the document's ``names`` replaced, and how many."""
    word = rf"(?<![\p{{L}}\p{{N}}_]){NAME_WORD}"
    found = F.regexp_extract_all(gap, F.lit(word), F.lit(0))
    told = lambda w: F.coalesce(F.map_contains_key("names", F.lower(w)), F.lit(False))
    new = F.transform(found, lambda w: F.when(told(w), cased(w, F.element_at("names", F.lower(w)))).otherwise(w))
    text = F.array_join(F.transform(F.split(gap, word, -1), lambda rest, i: F.concat(rest, F.when(i < F.size(new), new[i]).otherwise(""))), "")
    return F.when(F.col("names").isNull(), F.struct(gap.alias("text"), F.lit(0).alias("n"))).otherwise(F.struct(text.alias("text"), F.size(F.filter(found, told)).alias("n")))


def replace_entities(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every entity of ``text`` replaced, and ``n_entities``."""
    own = Own(docs)
    found = own.df.withColumns({"id": own[doc_id], "body": own[text]})
    hint = reduce(lambda a, b: a | b, [F.col("body").rlike(HINT_CHARACTERS), *[F.col("body").contains(t) for t in HINT_TEXTS], F.col("body").rlike(HINT_PATTERN)])
    hit = F.coalesce(F.when(hint, F.col("body").rlike(PATTERN)), F.lit(False))
    held = found.where(hit).withColumn("print", F.xxhash64("body"))
    held = computed(held, "matches", F.regexp_extract_all("body", F.lit(PATTERN), F.lit(0)))

    seen = held.select("id", "print", F.explode("matches").alias("value")).distinct()
    values = materialize(computed(computed(seen, "kind", kind_of(F.col("value"))), "parts", parts_of(F.col("kind"), F.col("value"))), "pii-values")
    # the parts of each distinct match meet their surrogates
    forms = materialize(values.select("value", "kind", "parts").distinct(), "pii-forms")
    parts = with_known_gender(forms.select("value", F.posexplode("parts").alias("k", "part")).select("value", "k", "part.kind", "part.canon"))
    parts = materialize(parts, "pii-parts")
    table = materialize(distinct_surrogates(parts.select("kind", "canon").distinct(), key), "pii-surrogates")
    drawn = parts.join(table, ["kind", "canon"])
    made = drawn.groupBy("value").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "surrogate"))), lambda x: x["surrogate"]).alias("made"))
    new = materialize(forms.select("value", "kind").join(made, "value").select("value", rendered(F.col("kind"), F.col("value"), F.col("made")).alias("new")), "pii-new")

    by_doc = values.select("id", "print", "value").join(new, "value").groupBy("id", "print").agg(F.map_from_entries(F.collect_set(F.struct("value", "new"))).alias("news"))
    # the parts of a document's names, each once: a given name before a surname
    known = (values.where("kind = 'name'").select("id", "print", "value").join(drawn.where(F.col("kind").rlike("latin|cyrillic")).withColumnRenamed("kind", "part"), "value")
             .groupBy("id", "print", "canon").agg(F.min(F.struct("part", "surrogate"))["surrogate"].alias("surrogate"))
             .groupBy("id", "print").agg(F.map_from_entries(F.collect_list(F.struct("canon", "surrogate"))).alias("names")))
    by_doc, known = (df.withColumnsRenamed({"id": f"_{n}id", "print": f"_{n}print"}) for n, df in (("", by_doc), ("n", known)))
    by_doc = by_doc.join(known, by_doc["_id"].eqNullSafe(known["_nid"]) & (by_doc["_print"] == known["_nprint"]), "left").drop("_nid", "_nprint")
    held = held.join(by_doc, held["id"].eqNullSafe(by_doc["_id"]) & (held["print"] == by_doc["_print"]))
    held = computed(held, "gaps", F.transform(F.split("body", PATTERN, -1), mentions))
    changed = F.array_join(F.transform("gaps", lambda gap, i: F.concat(gap["text"], F.when(i < F.size("matches"), F.element_at("news", F.col("matches")[i])).otherwise(""))), "")
    n_entities = F.size("matches") + F.aggregate("gaps", F.lit(0), lambda n, gap: n + gap["n"])

    def out(df: DataFrame, new_text: Column, n: Column) -> DataFrame:
        return df.select(*own.back(["n_entities"], {text: new_text}), n.cast("long").alias("n_entities"))

    return out(found.where(~hit), F.col("body"), F.lit(0)).unionByName(out(held, changed, n_entities))
