"""The registered queries of this folder and their SQL."""

from tickwarden.llm import archives, bpe, chat, decontaminate, embeddings, hard_negatives, lines, pii, simhash, suffix_tree, token_files, toxicity, turn_tries

QUERIES = {q.__name__: q for q in (suffix_tree.op1_suffix_tree, decontaminate.op2_decontaminate, toxicity.op3_toxicity, chat.op4_chat, embeddings.op5_embeddings, simhash.op6_simhash, pii.op7_pii, archives.op8_warc, lines.op9_lines, bpe.op10_bpe, turn_tries.op11_tries, hard_negatives.op12_negatives, token_files.op13_token_files)}
ORACLES: dict[str, str] = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op4_chat": chat.ORACLE,
    "op5_embeddings": embeddings.ORACLE,
    "op8_warc": archives.ORACLE,
    "op9_lines": lines.ORACLE,
    "op11_tries": turn_tries.ORACLE,
    "op12_negatives": hard_negatives.ORACLE,
}
