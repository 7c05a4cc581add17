"""Personal data, conversations and repeats against Python versions."""

import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirelake.llm.bwt import collect, merge, suffix_order
from hirelake.llm.chat import TEMPLATE, Guard, Reader, format_conversations, read_formatted
from hirelake.llm.pii import (
    KINDS, _corpus_patterns, _one_a_place, base_spans, candidate_spans, context_patterns, find_personal_data,
    held_out_recall, masked, spans_text,
)
from hirelake.llm.repeats import remove_repeats
from hirelake.llm.templates import Const, For, If, Output, Template, TemplateError, Text, parse

# --- personal data ----------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def base(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15
            ):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def found(df):
    return find_personal_data(df).select(
        "doc_id", spans_text(F.col("base")).alias("base"), spans_text(F.col("spans")).alias("spans")
    ).collect()


def test_base_spans(given, documents, awkward):
    _, rows = given("documents")
    rnd = random.Random(4)
    pieces = ["1.2.3.4", "a@b.c", "@", "+1 (22) 333-4444", " ", "é", ".", "-", "0", "4111 1111 1111 1111", "x", "+",
              "255.256.1.1", "000.0001.2.3", "_", "%", "😀", "\n", "378282246310005"]
    texts = [r[1] for r in rows] + awkward
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    texts += ["1" * 30000, "a" * 30000 + "@", "1 " * 9000 + "+1 " + "(" * 9000]
    got = {r.doc_id: r for r in found(documents(texts))}
    for i, text in enumerate(texts):
        assert got[i].base == base(text)
        assert got[i].spans.startswith(got[i].base)


def test_contexts_find_unseen_identifiers(documents):
    cards = ["4111111111111111", "378282246310005", "30569309025904", "6011111111111117"]
    texts = [f"words here account no: {c} and more {i}" for i, c in enumerate(cards)]
    texts += [f"other words account no: AB-77{i}412-X. more" for i in range(3)]
    texts += ["elsewhere stands AB-770412-X, again", "a plain number 1234567 here", "of 4111111111111111 and", "of 9876543 and"]
    spans = {r.doc_id: r.spans for r in found(documents(texts))}
    at = texts[4].index("AB-")
    assert spans[4] == f"found:{at}:{at + 11}"
    assert spans[7] == "found:17:28"  # the same identifier behind other words
    assert spans[8] == "" and spans[10] == "" and spans[9].startswith("card:")


def test_contexts_glued_to_the_identifier(documents):
    """Label and identifier in one run of characters, other words all around; the
    label also stands free once."""
    cards = ["4111111111111111", "378282246310005", "30569309025904", "6011111111111117",
             "5555555555554444", "4012888888881881"]
    lines, want = [], []
    for n, (label, close) in enumerate([("tel:", ""), ("id=", ""), ("<", ">"), ('"mail":"', '","x":1}'), ("ref#", "")]):
        lines += [f"w{chr(97 + i)}x {label}{c}{close} more {i}" for i, c in enumerate(cards)]
        unseen = [f"v{chr(97 + i)}y {label}77{n}{i}412{close} rest" for i in range(3)]
        want += [(len(lines) + i, t.index(f"77{n}{i}412")) for i, t in enumerate(unseen)]
        lines += [*unseen, f"free {label} sign"]
    spans = {r.doc_id: r.spans for r in found(documents([*lines, "elsewhere stands 7700412, again", "a plain number 1234567 here"]))}
    for i, at in want:
        assert spans[i] == f"found:{at}:{at + 7}"
    assert spans[len(lines)] == "found:17:24" and spans[len(lines) + 1] == ""


SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”„‘’«»"
GAP = " \t\n\x0b\f\r"


def words_of(text):
    sign, gap = re.escape(SIGNS), re.escape(GAP)
    found = re.findall(f"[0-9]+|[^0-9{sign}{gap}]+|[{sign}]", text)
    return [re.sub("[1-9]", "0", w.lower()) for w in found]


def patterns_at(words, i):
    """The last word that is no sign with the up to three signs after it, the same and
    one more, the sign alone; what the text's beginning cuts off is none."""

    def size(at):
        signs = 0
        while signs < 3 and at - signs >= 0 and words[at - signs] in SIGNS:
            signs += 1
        return signs + 1

    one = size(i)
    sizes = [one, one + size(i - one)] + ([1] if one > 1 else [])
    return [tuple(words[i - n + 1 : i + 1]) for n in sizes if n <= i + 1]


def contexts(o):
    left, sign, gap = o.left, re.escape(SIGNS), re.escape(GAP)
    if o.s > len(left):
        left = re.sub(f"^[^{sign}{gap}]+", "", left)
    letter = f"[^0-9{sign}{gap}]"
    for kind in (letter, "[0-9]"):
        if re.search(f"{kind}\\Z", o.left) and re.match(kind, o.text):
            return []
    words = words_of(left)
    return patterns_at(words, len(words) - 1)


def scored(texts, occurrences, is_seed, support=3, confident=0.5, sure=0.8):
    """Scores of all instances; ``occurrences`` are one list for each text."""
    total, n = Counter(), Counter()
    for text in texts:
        words = words_of(text)
        total.update(p for i in range(len(words)) for p in patterns_at(words, i))
    n.update((p, o.text.lower()) for own in occurrences for o in own for p in contexts(o))
    wide = Counter(p for p, _ in n)
    n = {(p, x): c for (p, x), c in n.items() if wide[p] >= support}
    seeds = {o.text.lower() for own in occurrences for o in own if is_seed(o)}
    scores, before = dict.fromkeys(seeds, 1.0), -1
    while True:
        sums, known = Counter(), Counter()
        for (p, x), c in n.items():
            sums[p] += c * scores.get(x, 0.0)
            known[p] += scores.get(x, 0.0) >= sure
        confidence = {p: sums[p] / total[p] for p in sums if known[p] >= support and sums[p] >= confident * total[p]}
        wrong = {}
        for p, x in n:
            if x not in seeds and p in confidence:
                wrong[x] = wrong.get(x, 1.0) * (1 - min(confidence[p], 0.999))
        risen = dict.fromkeys(seeds, 1.0) | {x: 1 - w for x, w in wrong.items()}
        gain = max((v - scores.get(x, 0.0) for x, v in risen.items()), default=0)
        scores, count = risen, sum(v >= sure for v in risen.values())
        if count == before and gain <= 0.001:
            return scores, seeds
        before = count


def labelled_texts(rnd):
    """Identifiers behind labels that hold for them always, mostly or seldom."""
    cards = ["4111111111111111", "378282246310005", "30569309025904", "6011111111111117", "5555555555554444"]
    seeds = [*cards, *(f"u{i}@mail{i % 3}.org" for i in range(20)), *(f"10.0.{i}.7" for i in range(9))]
    unseen = [f"AB-{i}7{i % 7}41{i}" for i in range(60)]
    labels = ["account no: ", "tel:", "id=", "<", "see also ", "ref #", "the ", "Der Schlüssel ", "x. "]
    texts = []
    for _ in range(400):
        line = []
        for _ in range(rnd.randint(0, 5)):
            k = rnd.randrange(len(labels))
            known, new, word = (6, 3, 1) if k < 4 else (2, 2, 4)
            thing = rnd.choices([rnd.choice(seeds), rnd.choice(unseen[k * 6 : k * 6 + 8]), "word"], (known, new, word))[0]
            line.append(rnd.choice(["some", "é", "3 of", "more,", "\n"]) + " " + labels[k] + thing + rnd.choice(["", ".", ">", " x"]))
        texts.append(" ".join(line))
    return texts


def occurrences_of(df, n):
    df = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("base", base_spans(F.col("text")))
    spans = F.concat(_one_a_place(F.col("base")), candidate_spans(F.col("text"), F.col("base")))
    out = [[]] * n
    for r in df.select("doc_id", spans.alias("spans")).collect():
        out[r.doc_id] = r.spans
    return out


def test_scores_of_the_graph_by_brute_force(documents, awkward):
    texts = labelled_texts(random.Random(7)) + awkward
    df = documents(texts)
    occurrences = occurrences_of(df, len(texts))
    scores, seeds = scored([t or "" for t in texts], occurrences, lambda o: o.kind != "found")
    new = {x for x, v in scores.items() if v >= 0.8 and x not in seeds}
    assert 10 < len(new) < 60
    for r in found(df):
        own = sorted((o.s, o.e) for o in occurrences[r.doc_id] if o.kind == "found" and o.text.lower() in new)
        assert r.spans == ",".join([*filter(None, [r.base]), *(f"found:{s}:{e}" for s, e in own)])


def test_what_follows_confident_patterns(documents):
    """Identifiers of any shape and number of digits, where their labels are sure."""
    texts = [f"words {i} {label}{x} more" for i in range(30) for label, x in
             [("mail: ", f"user{i}@site{i % 5}.org"), ("host ", f"10.1.{i}.9"), ("call ", f"+44 20 7946 {1000 + i}")]]
    long_ = "a.b_" * 60 + "9"
    more = {
        "please call 020 7946 0958 now": "020 7946 0958", "so call (555) 123-4567.": "(555) 123-4567",
        "my mail: carol@localhost, thanks": "carol@localhost", "the mail: dave (at) x.org;": "dave (at) x.org",
        "é host  \n db7.": "db7", f"mail: {long_} end": long_,
        "mail: later 12": "", "3 calls, 020 7946 0958": "", "host": "", "call me": "",
    }
    texts += more
    ids = [*range(len(texts)), None, None, 7000, 7000]
    got = found(documents([*texts, *["x host qq1"] * 4], ids))
    spans = {r.doc_id: r.spans for r in got}
    for i, (text, own) in enumerate(more.items(), len(texts) - len(more)):
        s = text.index(own)
        assert spans[i] == (f"found:{s}:{s + len(own)}" if own else "")
    assert [r.spans for r in got if r.doc_id in (None, 7000)] == ["found:7:10"] * 4


def test_contexts_further_off_than_a_window(documents):
    """White space or a long word before an identifier hides no pattern word."""
    cards = ["4111111111111111", "378282246310005", "30569309025904", "6011111111111117"]
    texts = [f"paid ={' ' * 300}{c} x" for c in cards] + [f"paid ={' ' * 300}9{i}0001 x" for i in range(2)]
    spans = {r.doc_id: r.spans for r in found(documents(texts))}
    assert [spans[4], spans[5]] == ["found:306:312"] * 2


def test_held_out_identifiers_are_found(documents):
    """Of labelled identifiers that are no seeds at least nine of ten come back."""
    texts = [f"words {i} {label}{x} more" for i in range(40) for label, x in
             [("mail:", f"user{i}@site{i % 5}.org"), ("host ", f"10.1.{i}.9"), ("call ", f"+44 20 7946 {1000 + i}")]]
    rows = {r.kind: r for r in held_out_recall(documents(texts)).collect()}
    assert rows.keys() == {"email", "ip", "phone"}
    assert all(r.n_held >= r.n_reachable >= r.n_found >= 0.9 * r.n_held > 0 for r in rows.values())
    bare = [f"user{i}@site.org\n" for i in range(40)]  # nothing stands before them
    assert {r.kind: (r.n_reachable, r.n_found) for r in held_out_recall(documents(bare)).collect()} == {"email": (0, 0)}
    assert held_out_recall(documents([])).count() == 0


def test_identifiers_many_patterns_away(documents):
    """Each label stands before the identifiers of the label before it and three new ones."""
    cards = ["4111111111111111", "378282246310005", "30569309025904", "6011111111111117"]
    texts = [f"aa {c} x" for c in cards]
    texts += [f"aa 90{i}0000 x" for i in range(3)]
    for k, label in enumerate(["bb", "cc", "dd", "ee", "ff", "gg"]):
        texts += [f"{label} 9{k}{i}0000 x" for i in (0, 1, 2, 0, 1)]
        texts += [f"{label} 9{k + 1}{i}0000 x" for i in range(3)]
    spans = {r.doc_id: r.spans for r in found(documents(texts))}
    assert all(spans[i] == "found:3:10" for i in range(7, len(texts)))


def test_a_place_counts_once_on_both_sides(documents, spark):
    """No pattern has more identifiers behind it than places."""
    texts = ["(a@b.c)", "x (d@e.f)", "(4111111111111111@g.h) (", "éa@b.c", "ip1.2.3.4 v5.6.7.8", "mail:a@b.c,d@e.f;key=a@b.c"] * 3
    df = documents(texts).select("text", base_spans(F.col("text")).alias("base"))
    seen = df.select(F.explode(_one_a_place(F.col("base"))).alias("o")).select(F.explode(context_patterns(F.col("o"))).alias("hash"))
    n = {r.hash: r["count"] for r in seen.groupBy("hash").count().collect()}
    total = {r.hash: r["count"] for r in _corpus_patterns(df).groupBy("hash").count().collect()}
    assert n and all(c <= total[h] for h, c in n.items())


def test_personal_data_without_rows_and_repeats(documents):
    assert find_personal_data(documents([])).count() == 0
    rows = found(documents(["a@b.co", "a@b.co", None], [1, 1, None]))
    assert sorted(r.spans for r in rows) == ["", "email:0:6", "email:0:6"]


def test_masked_text(spark):
    df = spark.createDataFrame(
        [("é a@b.co x", [("email", 2, 8)]), ("12345", [("card", 0, 4), ("found", 2, 5)]), ("same", [])],
        "text string, spans array<struct<kind:string,s:int,e:int>>",
    )
    assert [r[0] for r in df.select(masked(F.col("text"), F.col("spans"))).collect()] == ["é [email] x", "[card]5", "same"]


def test_no_python_in_the_plan(documents):
    plan = find_personal_data(documents(["a@b.co"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- conversations ----------------------------------------------------------


def test_folding_and_closures():
    t = Template("{{ 'a' ~ 'b' }}{% if 1 < 2 %}c{% else %}d{% endif %}{% if false %}e{% endif %}")
    assert t.tree == (Text("abc"),)
    loop = Template("{% for m in ms %}{{ loop.index0 }}{{ m['k'] | upper }}{% if not loop.last %}, {% endif %}{% endfor %}")
    assert "".join(x for x, _ in loop.render(ms=iter([{"k": "x"}, {"k": "y"}]))) == "0X, 1Y"
    learned = Template("a{% generation %}b{% set c = 'c' %}{{ c }}{% endgeneration %}d{# no #}")
    assert list(learned.render()) == [("a", False), ("b", True), ("c", True), ("d", False)]
    assert parse("{% for m in x -%}  {{ m }}{%- endfor %}")[0] == For("m", parse("{{ x }}")[0].value, (Output(parse("{{ m }}")[0].value),))
    assert isinstance(parse("{% if a %}b{% elif true %}c{% endif %}")[0].other[0], If)
    assert parse("{{ 'it\\'s\\n' }}")[0].value == Const("it's\n")


@pytest.mark.parametrize(
    "bad", ["{% for x in y %}", "{{ a b }}", "{% endif %}", "{{ x | nothing }}", "{{ '' }}{% nope %}", "{{ a( }}", "{{ }}"]
)
def test_bad_templates(bad):
    with pytest.raises(TemplateError):
        Template(bad)


def test_templates_reach_only_what_they_are_given():
    for source in ("{{ m.__class__ }}", "{{ x }}", "{{ m.text.upper }}"):
        with pytest.raises(TemplateError):
            list(Template(source).render(m={"text": "t"}))


@settings(max_examples=300, deadline=None)
@examples(st.lists(st.tuples(
    st.sampled_from(["user", "assistant", "system", "", "[TEXT]"]),
    st.lists(st.sampled_from(["[INST]", "[/INST]", "</s>", "\\", "<", "[ROLE]", " ", "a", "[INST", "/s>", "é", "\n"])).map("".join),
), max_size=5), st.integers(1, 9))
def test_conversations_are_read_back(turns, cut):
    guard = Guard()
    messages = [{"role": r, "text": t} for r, t in turns]
    pieces = list(Template(TEMPLATE, {"guard": guard.escape}).render(messages=messages))
    text = "".join(p for p, _ in pieces)
    reader, got = Reader(guard), []
    for i in range(0, len(text), cut):
        got += reader.feed(text[i : i + cut])
    reader.finish()
    assert got == turns
    assert [guard.unescape(p) for p, learned in pieces if learned] == [t for r, t in turns if r == "assistant" and t]


TURNS = "conv_id long, turn long, role string, text string, part string, loss int"


def check_conversations(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    got = {r.conv_id: r for r in read_formatted(format_conversations(df)).collect()}
    by = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1], r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        said = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert got[c].formatted_chars >= sum(len(t) for _, t in turns)


def test_given_conversations(spark, given):
    check_conversations(spark, given("conversations")[1])


def test_awkward_conversations(spark, awkward):
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said), (1, 0, None, None), (1, 0, "assistant", None),
            (2, None, "assistant", "a"), (2, 1, "assistant", "b"), (2, 1, "assistant", "b"), (None, 0, "user", "x")]
    rows += [(3, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(awkward)]
    rows += [(4, i, "assistant", "[INST]" * 60_000) for i in range(3)]
    check_conversations(spark, rows)
    assert read_formatted(format_conversations(spark.createDataFrame([], TURNS))).count() == 0


# --- repeats ----------------------------------------------------------------


def without_repeats(rows, length):
    seen, out = {}, {}
    for i, text in sorted(set(rows), key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if seen.setdefault(window, (i, s)) != (i, s):
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check_repeats(df, rows, length, **options):
    want = without_repeats(rows, length)
    got = remove_repeats(df, length, **options).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
    return sum(r.n_removed for r in got)


def test_given_documents(given):
    df, rows = given("documents")
    assert check_repeats(df, [r[:2] for r in rows], 100) > 0


@pytest.mark.parametrize("most_runs", [20_000, 2])
def test_small_alphabet(documents, most_runs):
    rnd = random.Random(5)
    stock = ["".join(rnd.choice("ab") for _ in range(40)) for _ in range(6)]
    texts = ["".join(rnd.choice([*stock, "c", "é"]) for _ in range(rnd.randrange(12))) for _ in range(60)]
    texts += ["a" * 200, "a" * 150, "ab" * 90]
    assert check_repeats(documents(texts), list(enumerate(texts)), 30, gram=12, most_runs=most_runs, batch_bytes=3000) > 500


def test_awkward_repeats(documents, awkward):
    check_repeats(documents(awkward), list(enumerate(awkward)), 100)
    same = "some text that is long enough to be found again, " * 5
    check_repeats(documents([same, same, "x"], [4, 4, 9]), [(4, same), (4, same), (9, "x")], 100)
    rows = remove_repeats(documents([same, same], [None, 2]), 100).collect()
    assert [r.n_removed > 0 for r in sorted(rows, key=lambda r: r.doc_id is None)] == [True, False]
    assert remove_repeats(documents([]), 100).count() == 0


def test_merge_orders_suffixes_and_finds_common_prefixes():
    import numpy as np

    rnd = np.random.default_rng(6)
    for depth in (4, 10, 20):
        strings = [rnd.integers(97, 100, rnd.integers(1, 60)).astype(np.uint8) for _ in range(25)]
        c = collect(strings, 4, depth)
        suffix, block = merge(c, depth)
        assert sorted(suffix.tolist()) == list(range(len(c.symbols)))
        prefix = []
        for p in suffix.tolist():
            rest = c.symbols[p : p + depth].tolist()
            end = rest.index(0) if 0 in rest else len(rest)
            prefix.append(tuple(rest[:end]))
        assert prefix == sorted(prefix)
        for a, b, x, y in zip(prefix[:-1], prefix[1:], block[:-1], block[1:], strict=True):
            assert (a == b) == (x == y)


def test_merge_of_windows_keeps_only_those_that_repeat():
    import numpy as np

    rnd = np.random.default_rng(7)
    for depth, most in ((4, 3), (10, 3), (20, 2), (20, 1), (7, 4)):
        strings = [rnd.integers(97, 97 + most, rnd.integers(depth, 60)).astype(np.uint8) for _ in range(25)]
        windows = np.array([rnd.integers(0, len(s) - depth + 2) for s in strings])
        c = collect(strings, 4, depth)
        suffix, block = merge(c, depth, windows)
        found = {}
        for p, b in zip(suffix.tolist(), block.tolist(), strict=True):
            found.setdefault(b, []).append((int(c.strings[c.string[p]]), int(c.inside[p])))
        want = {}
        for i, s in enumerate(strings):
            for a in range(windows[i]):
                want.setdefault(s[a : a + depth].tobytes(), []).append((i, a))
        assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)
        assert block.tolist() == sorted(block.tolist())


def test_suffix_order():
    import numpy as np

    s = np.frombuffer(b"banana" * 30 + b"\x01", np.uint8)
    want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert suffix_order(s, 500).tolist() == want
