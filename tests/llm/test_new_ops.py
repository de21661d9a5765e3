"""Alignment (op11), conversation repair (op12) and priority-queue BPE (op13) against brute force and the libraries."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest

from ticketlens.llm import alignment, pq_bpe, queries, repair

public_tokenizers = pytest.importorskip("public_tokenizers")
JSON = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
BLANKS = " \t\n\x0b\x0c\r"


def made_texts():
    rng = random.Random(11)
    words = ["the", "Über", "a", "ß", "don't", "  ", "x1", "</s>", "<s>", "<|endoftext|>", "中文", "😀", "\t", "long" * 30]
    made = [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(40)]
    return [*made, None, "", "same text.", "same text.", "\n\n", "z" * 5000, " lead", "trail "]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sf")
    texts = made_texts()
    rows = [(i if i % 17 else None, t, "x", 1) for i, t in enumerate(texts)] + [(3, texts[3], "x", 1)]  # null ids, a repeated row
    spark.createDataFrame(rows, "doc_id long, text string, ids string, n_a int").write.parquet(str(root / "documents.parquet"))
    convs = conversation_rows()
    spark.createDataFrame(convs, "conv_id long, turn long, role string, text string, audit string").write.parquet(
        str(root / "conversations.parquet")
    )
    return str(root), rows, convs


# --- op13 -------------------------------------------------------------------------------------


def test_merge_piece_is_plain_bpe():
    merges = {(1, 2): (0, 10), (10, 3): (1, 11), (2, 3): (2, 12), (1, 1): (3, 13)}
    assert pq_bpe.merge_piece([1, 2, 3], merges) == [11]
    assert pq_bpe.merge_piece([1, 1, 1], merges) == [13, 1]  # leftmost first on equal rank
    assert pq_bpe.merge_piece([], merges) == [] and pq_bpe.merge_piece([5], merges) == [5]


def test_op13_equals_the_library(spark, folder):
    from tokenizers import Tokenizer

    root, rows, _ = folder
    library = Tokenizer.from_file(JSON)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op13_pq_bpe(spark, root).collect())
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append(
            (
                doc_id is None,
                doc_id or 0,
                len(ids),
                hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest(),
            )
        )
    assert got == sorted(want)


def test_encode_keeps_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, "keep"), (2, "<|endoftext|>x", "keep")], "doc_id long, text string, ids string")
    out = pq_bpe.encode(docs, JSON, out="_ids").orderBy("doc_id").collect()
    assert [r["ids"] for r in out] == ["keep", "keep"] and out[0]["_ids"] == [] and out[1]["_ids"][0] == 50256
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pq_bpe.decode(pq_bpe.encode(empty, JSON), JSON).count() == 0


# --- op11 -------------------------------------------------------------------------------------


def brute_alignment(rows):
    import sentencepiece

    vocabulary = pq_bpe.Vocabulary(JSON)
    encoder = pq_bpe.Encoder(vocabulary, split_added=False)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    b_bytes = alignment.piece_bytes(MODEL)
    per_doc, docs_of = [], Counter()
    for doc_id, text, *_ in rows:
        text = text or ""
        a_ids = encoder.encode(" " + text).tolist() if text else []
        b_ids = model.encode(text) if text else []
        a_parts = [vocabulary.token_bytes[i] for i in a_ids]
        b_parts = [b_bytes[i] for i in b_ids]
        want = (" " + text).encode()
        if not text or b"".join(a_parts) != want or b"".join(b_parts) != want:
            per_doc.append((doc_id, 0, 0, 0, Counter(), ""))
            continue
        a_end, b_end = np.cumsum([len(p) for p in a_parts]), np.cumsum([len(p) for p in b_parts])
        a_start, b_start = a_end - [len(p) for p in a_parts], b_end - [len(p) for p in b_parts]
        cuts = sorted(set(a_end.tolist()) & set(b_end.tolist()))
        groups, lo = [], 0
        for cut in cuts:
            ga = [a_ids[i] for i in range(len(a_ids)) if lo < a_end[i] <= cut]
            gb = [b_ids[j] for j in range(len(b_ids)) if lo < b_end[j] <= cut]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            lo = cut
        linked = Counter(
            (a_ids[i], b_ids[j])
            for i in range(len(a_ids))
            for j in range(len(b_ids))
            if a_start[i] < b_end[j] and b_start[j] < a_end[i]
        )
        docs_of.update(linked.keys())
        per_doc.append((doc_id, len(a_ids), len(b_ids), len(cuts), linked, ";".join(groups)))
    top = Counter()
    for (a, _), n in docs_of.items():
        top[a] = max(top[a], n)
    out = []
    for doc_id, n_a, n_b, n_groups, linked, said in per_doc:
        out.append(
            (
                doc_id is None,
                doc_id or 0,
                n_a,
                n_b,
                n_groups,
                sum(linked.values()),
                sum(n for pair, n in linked.items() if docs_of[pair] == top[pair[0]]),
                sum(n * docs_of[pair] for pair, n in linked.items()),
                hashlib.sha256(said.encode()).hexdigest() if n_a else "",
            )
        )
    return sorted(out)


def test_op11_equals_brute_force(spark, folder):
    root, rows, _ = folder
    got = sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"])
        for r in queries.op11_cross_tokenizer_alignment(spark, root).collect()
    )
    assert got == brute_alignment(rows)
    assert any(g[2] for g in got) and any(not g[2] for g in got)


def test_cut_groups_split_at_every_common_end():
    rng = random.Random(3)
    for _ in range(300):
        total = rng.randint(1, 60)
        a = sorted(rng.sample(range(1, total), rng.randint(0, total - 1))) + [total]
        b = sorted(rng.sample(range(1, total), rng.randint(0, total - 1))) + [total]
        groups = alignment.cut_groups(a, b)
        assert len(groups) == len(set(a) & set(b))
        assert [a[g[1] - 1] for g in groups] == sorted(set(a) & set(b))
        a_last, b_last = alignment.cut_levels(np.array(a), np.array(b))
        assert a_last.tolist() == [g[1] - 1 for g in groups] and b_last.tolist() == [g[3] - 1 for g in groups]


def odd_texts():
    rng = random.Random(20)
    atoms = ["the", "Über", "don't", " ", "  ", "   ", "x1", "</s>", "<|endoftext|>", "中文", "😀", "\t", "\n", "\r\n", "\u3000", "\xa0", "\x1c"]
    atoms += ["\u2581", "\u2581a", "\u0301", "'s", "'", "ll", "12", ".", "long" * 20, "\u200b", "\x00", "word", " a", "ing", "．"]
    made = ["".join(rng.choices(atoms + [" "] * 12, k=rng.randint(1, 40))) for _ in range(1500)]
    return [*made, None, "", " ", "  ", "\n", " \n", "\n ", "a ", "a  ", " a", "  a  ", "\t ", "\u2581", " \u2581 ", "z" * 3000, "q " * 3000]


def per_text(found):
    ends = np.cumsum(found["n_pairs"]).tolist()
    pairs = list(zip(found["la"].tolist(), found["lb"].tolist(), found["ln"].tolist()))
    linked = [Counter({(a, b): n for a, b, n in pairs[s:e]}) for s, e in zip([0, *ends], ends)]
    return list(zip(found["n_a"].tolist(), found["n_b"].tolist(), found["n_groups"].tolist(), linked, found["groups_sha256"]))


def test_words_align_as_whole_texts_do():
    merges, a_sizes, path, b_bytes, split = alignment.tokenizers(JSON, MODEL)
    assert split
    texts = odd_texts()
    by_words = per_text(alignment.Aligner(merges, a_sizes, path, b_bytes, True).batch(texts))
    assert by_words == per_text(alignment.Aligner(merges, a_sizes, path, b_bytes, False).batch(texts))
    # a memory that is full at once, texts in several passes, and nothing but a text that has no tokens
    assert by_words == per_text(alignment.Aligner(merges, a_sizes, path, b_bytes, True, chunk=2000, memory=40).batch(texts))
    assert per_text(alignment.Aligner(merges, a_sizes, path, b_bytes, True).batch(["\u2581", None])) == [(0, 0, 0, Counter(), "")] * 2
    brute = brute_alignment([(i, t) for i, t in enumerate(texts)])
    got = [(False, i, *r[:3], sum(r[3].values()), r[4]) for i, r in enumerate(by_words)]
    assert got == [(*b[:6], b[8]) for b in brute]


def test_words_are_cut_where_both_tokenizers_end():
    assert alignment.words("a b c") == ["a", "b", "c"]
    assert alignment.words("a b ") == ["a", "b "] and alignment.words(" ") == [" "]
    assert alignment.words("a  b\n c") == ["a", " b\n c"]  # white space before a space: A's pre-tokens may run on
    for text in filter(None, odd_texts()):
        parts = alignment.words(text)
        assert "".join(" " + p for p in parts) == " " + text and all(parts)


def test_a_word_is_aligned_once_and_kept_when_met_again(monkeypatch):
    aligner = alignment.Aligner(*alignment.tokenizers(JSON, MODEL), chunk=200, memory=60)
    learned, learn = Counter(), aligner._learn
    monkeypatch.setattr(aligner, "_learn", lambda new: (learned.update(new), learn(new)))
    common = [f"common{i}" for i in range(20)]
    aligner.batch([" ".join([*common, *common, f"rare{i}"]) for i in range(300)])
    assert all(learned[w] == 1 for w in common) and len(learned) == 320
    assert len(aligner.known) <= 61


# --- op12 -------------------------------------------------------------------------------------


def conversation_rows():
    rng = random.Random(8)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None]
    texts = ["Hello.", "hi", "", "   ", "Sure thing!", "why?", None, "ok. ", "same."]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(0, 9)):
            rows.append((conv, rng.choice([turn, turn, None, 3]), rng.choice(roles), rng.choice(texts), "clash"))
    rows += [(None, 1, "user", "null conversation.", "x"), (None, None, "assistant", "Fine.", "x")]
    rows += [(999, t, "user" if t % 2 else "assistant", f"turn {t % 50}.", "x") for t in range(400)]  # long, with repeats
    return rows


def brute_repair(rows):
    damaged = {}
    for conv, turn, role, text, *_ in rows:
        damaged.setdefault(conv, [])
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if d == 0:
            continue
        text = "" if d == 1 else re.sub(r"[.!?]", "", text) if d == 2 else text
        role = "user" if d == 4 else role
        damaged[conv] += [(turn, role, text, c) for c in range(2 if d == 3 else 1)]
    out = {}
    for conv, rs in damaged.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2], r[3]))
        seen, info = set(), []
        for _, role, text, _ in rs:
            shown = [c for c in text if c not in BLANKS]
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated"
            seen.add((role, text))
            info.append((role, text, fault))
        turns = [r[0] for r in rs if r[0] is not None]
        initials = [r[1][:1] for r in rs]
        moves = {0: 2, 1: 2, 3: 2, 2: 3}
        # cheapest (cost, audit) per state after each row, inserts relaxed before every row and at the end
        best = {0: (0, "")}

        def relax(best):
            for _ in range(3):
                for p, (c, a) in list(best.items()):
                    q = moves[p]
                    if q not in best or (c + 3, a + "I") < best[q]:
                        best[q] = (c + 3, a + "I")
            return best

        for role, _, fault in info:
            best, after = relax(best), {}
            extra = 3 if fault == "truncated" else 0
            for p, (c, a) in best.items():
                options = [(p, c + 4, "D")]
                if fault not in ("blank", "duplicate"):
                    keep = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(role[:1], {})
                    if p in keep:
                        options.append((keep[p], c + extra, "K"))
                    options.append((moves[p], c + 3 + extra, "R"))
                for q, cost, letter in options:
                    if q not in after or (cost, a + letter) < after[q]:
                        after[q] = (cost, a + letter)
            best = after
        best = relax(best)
        cost, audit = min(best[q] for q in (0, 3) if q in best)
        lines, k, state = [], 0, 0
        for letter in audit:
            if letter == "D":
                k += 1
                continue
            if letter == "K":
                role, state = info[k][0], {"s": 1, "u": 2, "a": 3}[info[k][0][:1]]
            else:
                role, state = ("assistant", 3) if state == 2 else ("user", 2)
            lines.append(role + ":" + ("" if letter == "I" else info[k][1]))
            k += letter != "I"
        count = Counter(f for *_, f in info)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            count["blank"],
            count["duplicate"],
            count["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_op12_equals_brute_force(spark, folder):
    root, _, convs = folder
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op12_conversation_repair(spark, root).collect()}
    want = brute_repair(convs)
    assert got == want
    assert any(v[5] for v in want.values()) and any(v[6] == "" for v in want.values())


def test_rules_share_without_changing_results():
    rng = random.Random(4)
    pieces = [np.array([rng.randrange(9) for _ in range(rng.randint(0, 30))]) for _ in range(40)]
    plain = repair.repair_pieces(pieces, rules=0)
    shared = repair.repair_pieces(pieces, rules=256)
    flat = lambda ms: [[[None if e is None else (e[0], repair._text(e[1])) for e in row] for row in m] for m in ms]
    assert flat(plain) == flat(shared)


def test_repair_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(empty).count() == 0


def test_quality_fit_stays_bounded_with_repeated_ids(spark, monkeypatch):
    from ticketlens.llm import quality

    docs = spark.createDataFrame([(1, f"text number {i}.") for i in range(300)] + [(2, "other.")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda examples, width: seen.append(len(examples)))
    quality.train(docs, labels, max_rows=1)
    quality.train(docs, labels, max_rows=5)
    assert seen == [1, 5]


def test_chat_records_that_cannot_be_read_become_layout_null_turns():
    from ticketlens.llm import chat

    known, table = chat.mapping_table(chat.LAYOUTS)
    odd = [
        '{"turn": "1", "role": "user", "text": "hi"}',
        '{"turn": 99999999999999999999999, "role": "user", "text": "hi"}',
        '{"turn": 1.5, "role": "user", "text": "hi"}',
        '{"turn": 1, "role": "user", "text": "\\ud800"}',
        "[" * 5000 + "]" * 5000,
        "not json",
    ]
    for payload in odd:
        assert chat.read_record(payload, known, table) == [(0, "unknown", payload, None)]
    mixed = chat.read_record('{"messages": [{"role": "user", "content": "a"}, 7, "x"]}', known, table)
    assert [t[1:] for t in mixed[1:]] == [("unknown", "7", None), ("unknown", "x", None)] and mixed[0][3] is not None
