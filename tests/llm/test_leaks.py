"""Leaks of benchmark items, verbatim and with other values."""

import random

import regex
from helpers import documents, prose

from tablemove.llm import contamination
from tablemove.llm.contamination import UNITS, decontaminate, leaks

ITEM = (
    "A train leaves Paris at 10:30 and travels 120 km at a speed of 60 km while another train leaves "
    "Lyon at 10:30 and travels the same way to Paris"
)
CHANGED = ITEM.replace("10:30", "9:15").replace("120", "340").replace("Paris", "Berlin").replace("Lyon", "Bonn")
TORN = CHANGED.replace("9:15", "8:00", 1)


def bench(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id long, text string, template string, hash string")


def sample(spark):
    items = bench(spark, [(1, ITEM), (1, ITEM), (2, prose(2, 40)), (3, "only four short words"), (4, None), (5, "")])
    rows = [
        (0, None), (1, ""), (2, prose(50, 200)), (3, f"{prose(51, 60)}. {ITEM}. {prose(52, 60)}"),
        (4, f"{prose(53, 60)}. {CHANGED}."), (5, f"{prose(54, 60)}. {TORN}."), (6, "before " + prose(2, 40)),
        (7, "Yes! only FOUR short, words!"), (8, prose(60, 30_000) + " " + prose(2, 40)), (6, "before " + prose(2, 40)),
        (9, prose(2, 40)[:40]), (None, f"Yes. {ITEM}"),
    ]
    return documents(spark, rows), items


def test_leaks(spark):
    docs, items = sample(spark)
    got = sorted(((r["doc_id"], r["item_id"], r["same_values"]) for r in leaks(docs, items).collect()), key=str)
    # In 5, one time of the item stands for two times of the document.
    expected = [(3, 1, True), (4, 1, False), (6, 2, True), (7, 3, True), (8, 2, True), (None, 1, True)]
    assert got == sorted(expected, key=str)


def test_wrapped_folded_and_renamed_copies(spark):
    short = "Tom has 5 apples and buys 7 more from Ann at the shop"
    renamed = short.replace("Tom", "Kim").replace("Ann", "Sue").replace("5", "3")
    long = (
        "Every morning Tom and Ann walk with Bob past Lee and Kim until Joe meets Sue near Rome while "
        "Max waits with Eve for Ida and Leo beside Oslo"
    )
    copies = {
        1: short.replace(" Ann", "\nAnn"), 2: short.replace(" Ann", "  Ann"), 3: short.replace(" Ann", "\tAnn"),
        4: short.replace("Ann", '"Ann"'), 5: short.replace("Ann", "(Ann)"), 6: short.lower(), 7: short.upper(),
        8: f"so {short}", 9: renamed, 10: f"Well. {renamed}", 11: f"so {renamed}", 12: short.replace(" ", "\u00a0"),
    }
    items = bench(spark, [(1, short), (2, long), (3, "Yes"), (4, "Yes 5"), (5, "here we were asked to sit by Ann")])
    rows = [*copies.items(), (20, long.replace(" ", "\n")), (21, long.lower()), (30, prose(70, 60) + " No. Bob 7 No")]
    rows.append((31, "here we were asked to sit by: Sue"))
    got = {(r["doc_id"], r["item_id"], r["same_values"]) for r in leaks(documents(spark, rows), items).collect()}
    expected = {(d, 1, d not in (9, 10, 11)) for d in copies} | {(20, 2, True), (21, 2, True), (31, 5, False)}
    assert got == expected


def readings_of(text):
    """The tokens and templates of a text, read word by word."""
    spaced = regex.sub(r"[\s\x85\p{Z}]+", " ", text or "")
    found = list(regex.finditer(r"\p{L}[\p{L}\p{M}\p{N}]*|\p{N}+(?:[.,:/]\p{N}+)*", spaced))
    tokens = [m.group() for m in found]
    inner = [bool(regex.search(r"[\p{L}\p{N},;] [\p{Ps}\p{Pi}\"'`]{0,3}$", spaced[: m.start()])) for m in found]
    plain = []
    for i, t in enumerate(tokens):
        number_before = i > 0 and tokens[i - 1][0].isnumeric()
        plain.append("#" if t[0].isnumeric() else "u" if t.lower() in UNITS and number_before else f"w{t.lower()}")
    capital = [bool(regex.match(r"\p{Lu}\p{Ll}", t)) for t in tokens]
    every = ["n" if c else p for c, p in zip(capital, plain, strict=True)]
    some = ["n" if c and i else p for c, i, p in zip(capital, inner, plain, strict=True)]
    return tokens, {"plain": plain, "inner": some, "every": every}


def expected_leaks(docs, items):
    """All alignments of all readings of all pairs, slot by slot."""
    found = set()
    for doc_id, text in docs:
        tokens, read = readings_of(text)
        for item_id, item in items:
            own, item_read = readings_of(item)
            for name, template in item_read.items():
                literal = any(w[0] == "w" for w in template)
                if not template or (name != "plain" and template == item_read["plain"]) or (name == "every" and not literal):
                    continue
                n = min(8, len(template))
                least = min(len(template) - n + 1, max(1, 13 - n + 1))
                for shift in range(-len(template), len(tokens)):
                    at = [
                        i for i in range(len(template) - n + 1)
                        if 0 <= i + shift and i + shift + n <= len(tokens)
                        and template[i : i + n] == read[name][i + shift : i + shift + n]
                    ]
                    pairs = set()
                    for i in at:
                        for j in range(i, i + n):
                            if template[j][0] != "w":
                                pairs.add((own[j].lower(), tokens[j + shift].lower()))
                    if name == "inner":
                        # Read without names, the same windows have to be one to one as well, where they match.
                        plain = item_read["plain"]
                        for i in range(len(plain) - n + 1):
                            if 0 <= i + shift and i + shift + n <= len(tokens) and plain[i : i + n] == read["plain"][i + shift : i + shift + n]:
                                pairs |= {(own[j].lower(), tokens[j + shift].lower()) for j in range(i, i + n) if plain[j][0] != "w"}
                    if len(at) >= least and len({a for a, _ in pairs}) == len(pairs):
                        found.add((doc_id, item_id))
    return found


def test_against_all_alignments(spark):
    rng = random.Random(12)
    words = ["apples", "went", "home", "the", "Tom", "Ann", "Rome", "5", "3.5", "12", "km", "hours", "buys", "and", "(Kim", '"Lee"', "Yes,", "end.", "no;"]

    def text(most):
        return rng.choice([" ", "  ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, most)))

    items = [(i, text(rng.choice([3, 9, 20, 30]))) for i in range(14)]
    docs = []
    for i in range(120):
        item = rng.choice(items)[1].split()
        part = item[rng.randint(0, 3) :] if rng.random() < 0.4 else item
        changed = {w: rng.choice(words) for w in set(part)} if rng.random() < 0.5 else {}
        kept = [changed.get(w, w) if w[0].isupper() or w[0].isdigit() else w for w in part]
        if rng.random() < 0.2:
            kept = [w.lower() for w in kept]
        docs.append((i, f"{text(15)} {' '.join(kept)} {text(15)}"))
    got = {(r["doc_id"], r["item_id"]) for r in leaks(documents(spark, docs), bench(spark, items)).collect()}
    expected = expected_leaks(docs, items)
    assert len(expected) > 30 and got == expected


def test_decontaminate(spark):
    docs, items = sample(spark)
    clean = decontaminate(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [0, 1, 2, 5, 9]


def test_empty_tables(spark):
    docs, items = sample(spark)
    assert leaks(docs.limit(0), items).count() == 0
    assert leaks(docs, items.limit(0)).count() == 0
    assert decontaminate(docs, items.limit(0)).count() == docs.count()


def test_main_path_is_native(spark):
    docs, items = sample(spark)
    plan = leaks(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_equal_windows_have_equal_hashes(spark):
    """Windows of every length by halves: as many as there are, equal for equal words only."""
    texts = ["", "a", "a b a b a b a b a b a b", "b a b c d e f g h a b c d e f g h i j", "c d e f g h a b c d"]
    frame = spark.createDataFrame([(i, t.split()) for i, t in enumerate(texts)], "id int, template array<string>")
    for length in range(1, 10):
        hashed = contamination._hashed_words(frame, ("template",), "id")
        rows = contamination._window_hashes(hashed, "template", length, "found").select("id", "found").collect()
        of_hash, of_window = {}, {}
        for row in rows:
            words = texts[row["id"]].split()
            windows = [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]
            assert len(windows) == len(row["found"])
            for window, found in zip(windows, row["found"], strict=True):
                assert of_hash.setdefault(found, window) == window and of_window.setdefault(window, found) == found


def test_tokens_without_marks_are_the_same_names(spark):
    """Where no item has names inside sentences, texts are read without marks, and all else is the same."""
    texts = ["Then Lisa, (Tom) and “Ann” met 5 Min ago; ⟨Bob said 7 Km, 𝐀𝐚 too. É Éa ab Cd eF", None, ""]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    marked = {r["id"]: (r["plain"], r["every"]) for r in contamination._canonical(frame, "id").collect()}
    bare = {r["id"]: (r["plain"], r["every"]) for r in contamination._canonical(frame, "id", readings=("plain", "every")).collect()}
    assert marked == bare
