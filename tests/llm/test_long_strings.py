import random
import struct

import sentencepiece

from debatelake.llm.piece_codec import PieceCodec
from debatelake.llm.queries import piece_model_path


def test_backtracking_covers_long_strings(monkeypatch):
    codec, sp = PieceCodec(open(piece_model_path(), "rb").read()), sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    merged, lengths = codec.merged, [0]
    monkeypatch.setattr(codec, "merged", lambda text: lengths.append(len(text)) or merged(text))
    r = random.Random(1)
    for text in ("x" * 9000, "".join(r.choice("abcdetheonr") for _ in range(30000))):
        ids = codec.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == sp.encode(text, add_bos=True, add_eos=True)
    assert max(lengths) <= 200
