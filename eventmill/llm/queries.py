"""Registered queries of the subpackage, with SQL checks where SQL can say the answer.

The others are held against brute force, exact round trips or held-out labels in
``tests/llm``.
"""

from eventmill.llm.blockjoin import OP12_SQL, op12_block_join
from eventmill.llm.extract import op4_block_labeller
from eventmill.llm.fptree import OP13_SQL, op13_fp_tree
from eventmill.llm.frames import OP11_SQL, op11_seekable_frames
from eventmill.llm.langid import op9_language_kernels
from eventmill.llm.mixing import op8_temperature_mixing
from eventmill.llm.neardup import op5_bbit_minhash
from eventmill.llm.packing import op7_dp_packing
from eventmill.llm.quality import op2_ngram_ratio
from eventmill.llm.rendezvous import OP10_SQL, op10_rendezvous_shards
from eventmill.llm.syncmers import op6_closed_syncmers
from eventmill.llm.toxicity import op3_toxicity_ordinal
from eventmill.llm.warc import OP1_SQL, op1_warc_dictionary

QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_dictionary, op2_ngram_ratio, op3_toxicity_ordinal, op4_block_labeller,
        op5_bbit_minhash, op6_closed_syncmers, op7_dp_packing, op8_temperature_mixing,
        op9_language_kernels, op10_rendezvous_shards, op11_seekable_frames, op12_block_join,
        op13_fp_tree,
    )
}
ORACLES = {
    "op1_warc_dictionary": OP1_SQL, "op10_rendezvous_shards": OP10_SQL,
    "op11_seekable_frames": OP11_SQL, "op12_block_join": OP12_SQL, "op13_fp_tree": OP13_SQL,
}
