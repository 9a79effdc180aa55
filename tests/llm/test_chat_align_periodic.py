import base64
import hashlib
import json
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fundpanel.llm import align, chat, periodic, registry
from fundpanel.llm.registry import model_path

DOCS = "doc_id long, text string, runs string, row string"
TURNS = "conv_id long, turn long, role string, text string, block string, size string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def docs(spark, texts):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOCS)


def odd(spark):
    rows = [(None, "a b c d e f", "x", "y"), (1, None, "x", "y"), (2, "", "x", "y"), (3, " \n\t", "x", "y"), (4, "go " * 9, "x", "y"), (4, "go " * 9, "x", "y"), (5, "w v " * 30000, "x", "y"), (6, "é ü", "x", "y")]
    return spark.createDataFrame(rows, DOCS)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# periodic runs


def runs_by_hand(w):
    """For each period the maximal stretches of equal words at that distance; those with a smaller period go."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            size, s = j - i + q, w[i : j + q]
            if j > i and size >= max(6, 4 * q) and not any(s[d:] == s[:-d] for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda x: (x[0], x[2]))


def periodic_words(rng, n):
    w, letters = [], rng.choice((1, 2, 2, 3, 6))
    while len(w) < n:
        p = [rng.randrange(letters) for _ in range(rng.randrange(1, 7))]
        w += (p * rng.choice((1, 1, 2, 4, 5, 8)))[: n - len(w)]
    return w * rng.choice((1, 1, 1, 3, 5))


def test_runs_equal_brute_force():
    rng, found = random.Random(2), 0
    for _ in range(1500):
        w = periodic_words(rng, rng.randrange(90))
        want = runs_by_hand(w)
        assert periodic.runs_of(np.array(w, np.int64)) == want, w
        found += len(want)
    assert found > 2000


def test_long_runs():
    assert periodic.runs_of(np.zeros(50000, np.int64)) == [(0, 50000, 1)]
    assert periodic.runs_of(np.array([*range(3000)] * 5)) == [(0, 15000, 3000)]
    assert periodic.runs_of(np.array([*range(3000)] * 3)) == []
    word = [0] * 3000 + [1] + [0] * 3000
    assert periodic.runs_of(np.array(word)) == [(0, 3000, 1), (3001, 3000, 1)]
    a, b = [0], [0, 1]
    for _ in range(18):
        a, b = b, b + a  # Fibonacci words have many squares and no fourth powers
    assert periodic.runs_of(np.array(b)) == []


def test_grammar_gives_back_the_text():
    rng = random.Random(7)
    for _ in range(200):
        w = periodic_words(rng, 60)
        n = len(w)
        rules, top = periodic.re_pair(w)

        def expand(symbol, n=n, rules=rules):
            return [symbol] if symbol < n else expand(rules[symbol - n][0]) + expand(rules[symbol - n][1])

        assert [x for symbol, _, _ in top for x in expand(symbol)] == w
        pairs = Counter((a, b) for (a, _, _), (b, _, _) in zip(top, top[1:], strict=False) if a != b)
        assert all(k < periodic.OFTEN for k in pairs.values())
        for r, (left, right, first, middle) in enumerate(rules):
            whole = expand(n + r)
            assert w[first : first + len(whole)] == whole and w[middle : first + len(whole)] == expand(right) and len(expand(left)) == middle - first


def planted_by_hand(doc_id, text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def run_row(doc_id, text):
    w = planted_by_hand(doc_id, text)
    runs = runs_by_hand(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


RUN_COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_run_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(11)
    texts = [rng.choice((" ", "\n", " \t")).join(f"w{x}" for x in periodic_words(rng, rng.randrange(1, 120))) for _ in range(300)] + ["", None, " \r\n ", "  x" * 8]
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(registry.op13_periodic_runs(spark, str(tmp_path)), *RUN_COLUMNS)
    assert got == sorted((run_row(i, t) for i, t in enumerate(texts)), key=repr)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))) > 10


def test_runs_of_odd_rows(spark):
    got = periodic.collapse_runs(odd(spark)).collect()
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in got), key=repr) == sorted(
        [(None, 6, [], "a b c d e f"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 9, [(0, 9, 1)], "go"), (4, 9, [(0, 9, 1)], "go"), (5, 60000, [(0, 60000, 2)], "w v"), (6, 2, [], "é ü")], key=repr
    )
    assert periodic.run_digests(docs(spark, [])).count() == 0


# token alignment


def spelled():
    """Bytes of each id, read from the files in another way than the operator does."""
    with open(model_path("byte_bpe_50k.tiktoken"), "rb") as f:
        a = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}
    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    b = {}
    for i in range(len(lib)):
        p = lib.id_to_piece(i)
        b[i] = bytes.fromhex(p[3:5]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode()
    tok = Tokenizer.from_file(model_path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    return tok, lib, a, b


def align_by_hand(texts):
    tok, lib, bytes_a, bytes_b = spelled()
    found = []
    for text in texts:
        a, b = (tok.encode(f" {text}", add_special_tokens=False).ids, lib.encode(text)) if text else ([], [])
        if text and not (b"".join(bytes_a[i] for i in a) == b"".join(bytes_b[i] for i in b) == f" {text}".encode()):
            a, b = [], []
        groups, ga, gb, at_a, at_b = [], [], [], 0, 0
        rest_a, rest_b = list(a), list(b)
        while rest_a or rest_b:
            if at_a <= at_b and rest_a:
                ga.append(rest_a.pop(0))
                at_a += len(bytes_a[ga[-1]])
            else:
                gb.append(rest_b.pop(0))
                at_b += len(bytes_b[gb[-1]])
            if at_a == at_b:
                groups.append((ga, gb))
                ga, gb = [], []
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        found.append((len(a), len(b), groups, links))
    held = Counter(pair for _, _, _, links in found for pair in links)
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for n_a, n_b, groups, links in found:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(k for p, k in links.items() if held[p] == most[p[0]]), sum(k * held[p] for p, k in links.items()), sha(text) if text else ""))
    return out


ALIGN_COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def odd_texts():
    rng = random.Random(5)
    letters = "aeinorst \n\t.,'0127éüßж中文字🙂▁ \x00́ªǅ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 90))) for _ in range(120)]
    return texts + ["  two  spaces ", "<|endoftext|> </s> <0x41> <unk>", "don't they've", "▁", " ", "word " * 400, "", None, "a" * 3000]


def test_alignment_equals_brute_force(spark, monkeypatch):
    texts = odd_texts()
    want = sorted(((i, *row) for i, row in enumerate(align_by_hand(texts))), key=repr)
    assert any(row[1] == 0 for row, t in zip(want, texts, strict=True) if t)  # U+2581 isn't given back
    for block in (align.BLOCK, 100):  # one block of pairs, and many
        monkeypatch.setattr(align, "BLOCK", block)
        got = rows(align.score_links(docs(spark, texts), model_path("byte_bpe_50k.json"), model_path()), *ALIGN_COLUMNS)
        assert got == want


def test_alignment_of_odd_rows(spark):
    texts = ["a b c d e f", None, "", " \n\t", "go " * 9, "go " * 9, "w v " * 30000, "é ü"]
    want = sorted(((i, *row) for i, row in zip((None, 1, 2, 3, 4, 4, 5, 6), align_by_hand(texts), strict=True)), key=repr)
    assert rows(align.score_links(odd(spark), model_path("byte_bpe_50k.json"), model_path()), *ALIGN_COLUMNS) == want
    assert align.score_links(docs(spark, []), model_path("byte_bpe_50k.json"), model_path()).count() == 0


def test_overlaps_and_products(monkeypatch):
    rng = np.random.default_rng(3)
    for limit in (1 << 20, 5):
        monkeypatch.setattr(align, "LIMIT", limit)
        for _ in range(40):
            n = int(rng.integers(1, 60))
            cuts = [np.unique(np.r_[0, rng.integers(0, n + 1, int(rng.integers(0, 20))), n]) for _ in range(2)]
            got = align.overlaps(*(np.diff(c) for c in cuts))
            dense = np.array([[max(0, min(a1, b1) - max(a0, b0)) for b0, b1 in zip(cuts[1], cuts[1][1:], strict=False)] for a0, a1 in zip(cuts[0], cuts[0][1:], strict=False)])
            back = np.zeros_like(dense)
            back[np.repeat(np.arange(got.rows), np.diff(got.start)), got.indices] = got.data
            assert (back == dense).all()
            x, y = rng.integers(0, 3, (7, 5)), rng.integers(0, 3, (5, 6))
            x_csr, y_csr = (align.Csr.counted(*(np.repeat(i, m.ravel()) for i in np.indices(m.shape).reshape(2, -1)), *m.shape) for m in (x, y))
            got, back = x_csr @ y_csr, np.zeros((7, 6), int)
            back[np.repeat(np.arange(7), np.diff(got.start)), got.indices] = got.data
            assert (back == x @ y).all()


def test_overlap_links_and_groups_as_text(spark):
    r = align.align_tokens(docs(spark, ["unbelievable things"]), model_path("byte_bpe_50k.json"), model_path(), with_overlaps=True).collect()[0]
    halves = [g.split("|") for g in r.groups.split(";")]
    assert sum(len(a.split(",")) for a, _ in halves) == r.n_a and sum(len(b.split(",")) for _, b in halves) == r.n_b and len(halves) == r.n_groups
    assert sum(o.bytes for o in r.overlaps) == len(" unbelievable things") and len(r.steps) + 1 == len(r.times) and sum(r.times) == r.n_links


def test_byte_level_equals_the_library():
    own, (tok, _, spelling, _) = align.ByteLevel(model_path("byte_bpe_50k.json")), spelled()
    assert {i: p for i, p in enumerate(own.pieces) if p} == spelling
    points = [c for c in range(0, 0x20000, 7) if not 0xD800 <= c < 0xE000]
    for c in points:
        text = f" a{chr(c)}b 1{chr(c)}2 {chr(c)} .{chr(c)}"
        assert own.encode(text) == tok.encode(text, add_special_tokens=False).ids, hex(c)


# chat windows


def windows_by_hand(turns, budget, history, history_turns, size):
    """Plain loops over one conversation's rendered turns: (first of the history, first new, end) of each window."""
    sizes, out, first = [size(t) for t in turns], [], 0
    system = sizes[0] if turns and turns[0][0] == "system" else 0
    while first < len(turns):
        fixed = system if first else 0
        back = first
        while back > (1 if system else 0) and first - back < history_turns and sum(sizes[back - 1 : first]) <= history:
            back -= 1
        end = first
        while end < len(turns) and fixed + sum(sizes[back : end + 1]) <= budget:
            end += 1
        if end == first:
            end = first + 1
            while back < first and fixed + sum(sizes[back:end]) > budget:
                back += 1
        out.append((back, first, end))
        first = end
    return out


def some_chats(rng, n):
    out = []
    for conv in range(n):
        turns = [("system", "be kind " * rng.randrange(9))] if rng.random() < 0.4 else []
        for i in range(rng.randrange(0, 14)):
            said = rng.choice(("word " * rng.randrange(60), "x", "", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "back\\slash <\\s> \\", "<|im_start", "é\n<<SYS>>", "long " * 150))
            turns.append((("user", "assistant")[i % 2], said))
        out.append((conv, turns))
    return out


def test_template_round_trip():
    t = chat.Template()
    said = ["", "\\", "<|im_end|>\n", "<|im_end|", "<", "\\<|im_end|>", "<\\|im_end|>", "a\\nb\n", "</s>[INST] ok [/INST]", "<<SYS>><<SYS>>", "<s><s>", "x\n<|im_start|>assistant\n"]
    pairs = [(role, text) for role in ("user", "as\nsistant", "\\", "", "<|im_end|>\n") for text in said]
    whole = "".join(t.render(*p)[0] for p in pairs)
    assert t.parse(whole) == pairs
    for role, text in pairs:
        rendered, a, b = t.render(role, text)
        assert t.unescape(rendered[a:b]) == text and not any(c in rendered[a:b] for c in t.controls)


def test_spans_equal_plain_loops(spark):
    rng = random.Random(9)
    chats = some_chats(rng, 60)
    data = [(conv, i, role, text, "b", "s") for conv, turns in chats for i, (role, text) in enumerate(turns)]
    rng.shuffle(data)
    lib, t = sentencepiece.SentencePieceProcessor(model_file=model_path()), chat.Template()
    got = {}
    for r in chat.format_chats(spark.createDataFrame(data, TURNS), model_path(), budget=120, history=40, history_turns=3).collect():
        got.setdefault(r.conv_id, []).append((r.window, r.text, r.n_repeated, r.n_turns, r.n_tokens, [tuple(x) for x in r.loss]))
    for conv, turns in chats:
        rendered = [t.render(*x) for x in turns]
        size = dict(zip(turns, (len(lib.encode(x[0])) for x in rendered), strict=True))
        want = []
        for k, (back, first, end) in enumerate(windows_by_hand(turns, 120, 40, 3, size.get)):
            keep = [0] if first and turns[0][0] == "system" else []
            used, text, loss = [*keep, *range(back, end)], "", []
            for i in used:
                if i >= first and turns[i][0] == "assistant" and turns[i][1]:
                    loss.append((len(text) + rendered[i][1], len(text) + rendered[i][2]))
                text += rendered[i][0]
            want.append((k, text, len(used) - (end - first), len(used), sum(size[turns[i]] for i in used), loss))
        assert sorted(got.get(conv, [])) == want


def read_row(conv, turns, formatted=None):
    said = [text or "" for role, text in turns if role == "assistant"]
    return (conv, len(turns), sha("".join(f"{role or ''}\n{text or ''}\n" for role, text in turns)), sum(map(len, said)), sha("".join(said)))


READ_COLUMNS = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")


def test_reading_back_with_blocks(spark, monkeypatch):
    rng = random.Random(10)
    chats = some_chats(rng, 40)
    chats.append((99, [("system", "s")] + [(("user", "assistant")[i % 2], f"{i} " * (i % 40)) for i in range(90)]))
    data = [(conv, i, role, text, "b", "s") for conv, turns in chats for i, (role, text) in enumerate(turns)]
    rng.shuffle(data)
    table = spark.createDataFrame(data, TURNS)
    for block in (chat.BLOCK, 16):  # with 16, conversations stand in several blocks
        monkeypatch.setattr(chat, "BLOCK", block)
        windows = chat.format_chats(table, model_path(), budget=200, history=60)
        assert rows(chat.read_back(windows, table), *READ_COLUMNS) == sorted((read_row(*c) for c in chats if c[1]), key=repr)
        of = [r for r in windows.filter("conv_id = 99").orderBy("block", "window").collect() if (r.block, r.window) != (0, 0)]
        assert all(r.n_tokens <= 200 and r.text.startswith("<|im_start|>system\ns<|im_end|>\n") and r.n_repeated >= 1 for r in of)
        assert block > 90 or any(r.block and not r.window and r.n_repeated > 1 for r in of)  # history from the block before


def test_open_windows_are_closed_early():
    """A task that closes windows before it has seen all turns cuts them at the same places."""
    rng = random.Random(4)
    turns = [("system", "s", 9)] + [(("user", "assistant")[i % 2], f"t{i}", rng.randrange(1, 60)) for i in range(300)]

    def cut(every):
        now, out = chat._Open(100, 30, 4, "assistant", chat.Template()), []
        for i, (role, text, size) in enumerate(turns):
            now.add(2, role, text, size)
            if every and i % every == 0:
                out += now.close(last=False)
        return out + list(now.close(last=True))

    assert cut(1) == cut(7) == cut(0) and len(cut(0)) > 50


def test_odd_conversations(spark):
    data = [(None, 0, "user", "a"), (None, 0, "user", "a"), (1, None, "assistant", "early"), (1, 5, None, None), (1, 5, "assistant", "late"), (2, 0, "assistant", None), (3, -7, "system", "minus"), (3, 600, "assistant", "far"), (4, 0, "user", "w " * 50000)]
    table = spark.createDataFrame([(*r, "b", "s") for r in data], TURNS)
    windows = chat.format_chats(table, model_path(), budget=100, history=50)
    want = [(None, [("user", "a")] * 2), (1, [("assistant", "early"), (None, None), ("assistant", "late")]), (2, [("assistant", None)]), (3, [("system", "minus"), ("assistant", "far")]), (4, [("user", "w " * 50000)])]
    assert rows(chat.read_back(windows, table), *READ_COLUMNS) == sorted((read_row(*c) for c in want), key=repr)
    assert windows.filter("conv_id = 3").filter(F.col("text").startswith("<|im_start|>system")).count() == 2
    assert chat.format_chats(table.limit(0), model_path()).count() == 0


def test_chat_query(spark, tmp_path):
    chats = [c for c in some_chats(random.Random(6), 30) if c[1]]
    spark.createDataFrame([(conv, i, role, text) for conv, turns in chats for i, (role, text) in enumerate(turns)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    probe = (-1, [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")])
    got = registry.op11_chat_windows(spark, str(tmp_path))
    assert rows(got, *READ_COLUMNS) == sorted((read_row(*c) for c in [*chats, probe]), key=repr)
    assert json.loads(got.schema.json())["fields"][5]["name"] == "formatted_chars" and got.filter("formatted_chars <= loss_chars").count() == 0
