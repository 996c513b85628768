"""The queries of this package, and their comparison SQL where SQL can say them."""

from .collisions import SQL as EMBEDDINGS, op5_embedding_dedup
from .curriculum import op2_curriculum
from .decontaminate import SQL as DECONTAMINATION, op4_decontaminate
from .katz import op1_katz
from .langid import op3_language_id
from .nsbounds import SQL as CENTROIDS, op13_centroids
from .prefixtrie import SQL as PREFIX_TRIE, op11_prefix_trie
from .pseudonyms import op6_pseudonyms
from .ranking import op12_quality
from .simhash import op9_simhash
from .suffixes import op10_suffix_dedup
from .tokenids import op8_token_ids
from .wrappers import op7_main_text

QUERIES = {
    "op6_pseudonyms": op6_pseudonyms,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op7_main_text": op7_main_text,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op1_katz": op1_katz,
    "op2_curriculum": op2_curriculum,
    "op3_language_id": op3_language_id,
    "op4_decontaminate": op4_decontaminate,
    "op8_token_ids": op8_token_ids,
    "op9_simhash": op9_simhash,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_quality": op12_quality,
    "op13_centroids": op13_centroids,
}

SQL: dict[str, str] = {
    "op4_decontaminate": DECONTAMINATION,
    "op5_embedding_dedup": EMBEDDINGS,
    "op11_prefix_trie": PREFIX_TRIE,
    "op13_centroids": CENTROIDS,
}
