"""A plain version of the alignment of two tokenizers."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
import tokenizers


def _offsets(lengths):
    out, at = [], 0
    for n in lengths:
        out.append((at, at + n))
        at += n
    return out


def align(texts):
    """The result without doc_id for each of `texts`, byte by byte and pair by pair."""
    a = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = {}
    hidden = 0
    for byte in range(256):
        if 33 <= byte < 127 or 161 <= byte < 173 or 174 <= byte < 256:
            letters[chr(byte)] = byte
        else:
            letters[chr(256 + hidden)] = byte
            hidden += 1

    def piece_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    documents = []
    for text in texts:
        found = None
        if text:
            whole = (" " + text).encode()
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [piece_bytes(i) for i in ids_b]
            if b"".join(bytes_a) == whole and b"".join(bytes_b) == whole:
                span_a, span_b = _offsets(map(len, bytes_a)), _offsets(map(len, bytes_b))
                ends_a, ends_b = [e for _, e in span_a], [e for _, e in span_b]
                groups, i, j = [], 0, 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    to_a, to_b = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
                    groups.append((ids_a[i:to_a], ids_b[j:to_b]))
                    i, j = to_a, to_b
                found = groups
        documents.append(found)
    counts = Counter()
    for groups in documents:
        counts.update({(x, y) for mine, its in groups or () for x in mine for y in its})
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for groups in documents:
        if groups is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for mine, its in groups for x in mine for y in its]
        name = ";".join(f"{','.join(map(str, m))}|{','.join(map(str, i))}" for m, i in groups)
        out.append((
            sum(len(m) for m, _ in groups), sum(len(i) for _, i in groups), len(groups), len(links),
            sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(name.encode()).hexdigest()))
    return out
