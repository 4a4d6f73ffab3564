"""Time and memory of what one task holds."""

import time

import pytest

from listenlytics.llm import bpe
from listenlytics.llm.pages import best_container, read_page, text_on_path

ODD_PAGES = {
    "unclosed": "<a " * 350_000,
    "unclosed quotes": '<a "x>" ' * 130_000 + '"',
    "closing": "</a " * 200_000,
    "raw": "<script " * 100_000,
    "nested": '<div class="aa bb">x' * 50_000,
    "stray": "<div>" * 50_000 + "</section>" * 50_000,
    "inline": "<b>" * 50_000 + "<div></div>" * 50_000,
    "sides": "<div class=ad>x" * 50_000,
}


@pytest.mark.parametrize("name", sorted(ODD_PAGES))
def test_odd_pages_take_linear_time(name):
    begin = time.perf_counter()
    page = read_page(ODD_PAGES[name])
    best_container(page)
    text_on_path(page, ["/div"])
    assert time.perf_counter() - begin < 5  # quadratic ones take minutes


def test_encoder_stays_small(sf_dir, monkeypatch):
    """Slices, pairs and pieces are bounded, and small bounds give the same ids."""
    import pyarrow.parquet as pq

    vocabulary, pattern = bpe.public_vocabulary()
    ranks = bpe.read_ranks(vocabulary)
    texts = pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"]).column(0).to_pylist()
    texts += ["word " * 200_000, "x" * 300_000, None, ""]
    wanted = bpe.Encoder(ranks, pattern).encode(texts[:-4] + texts[-2:])
    for name, value in (("CACHE_PIECES", 500), ("CACHE_PAIRS", 300), ("SLICE_BYTES", 1000), ("PORTION_PIECES", 777)):
        monkeypatch.setattr(bpe, name, value)
    encoder = bpe.Encoder(ranks, pattern)
    found = encoder.encode(texts)
    assert found[:-4] + found[-2:] == wanted
    assert bpe.Decoder(ranks).decode(found[-4]).decode() == texts[-4]
    assert bpe.Decoder(ranks).decode(found[-3]).decode() == texts[-3]
    assert len(encoder.replay.pairs) <= 300
