"""What operators leave in a worker goes before others work there."""

import public_tokenizers

from termweave.llm import arrays, packing


def test_vocabularies_leave_the_worker_with_the_next_operator():
    packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    arrays.keeps("packing", packing.forget)
    arrays.make_room("packing")
    assert packing.load_tokenizer.cache_info().currsize == packing.load_merges.cache_info().currsize == 1
    arrays.make_room("set_join")
    assert packing.load_tokenizer.cache_info().currsize == packing.load_merges.cache_info().currsize == 0
