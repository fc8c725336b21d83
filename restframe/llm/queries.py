"""All queries of this subpackage."""

from restframe.llm import bpe, embeddings, langid, linededup, linkgraph, lm, merkle, mixing, personal, simhash, tokenfile, topk, whitening
from restframe.llm.base import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "bpe", "embeddings", "langid", "linededup", "linkgraph", "lm", "merkle", "mixing", "personal", "simhash", "tokenfile", "topk", "whitening"
]
