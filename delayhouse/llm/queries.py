"""The registered queries of this package, and their SQL where SQL can express them.

Without SQL, and tested against brute force or held-out labels instead: token counts and packing (tokenizers), language-model
scoring, near-duplicates (components), quality (a fitted model), fingerprints, whitening (eigenvectors), page texts (a parser) and spelling
variants (checksums).
"""

from . import chat, fingerprints, html_text, lm_scoring, mixing, near_dedup, packing, quality, secrets, spelling, token_counts, topk, whitening


def queries():
    return {
        "op1_token_counts": token_counts.query,
        "op2_best_fit_packing": packing.query,
        "op3_lm_scoring": lm_scoring.query,
        "op4_secret_scans": secrets.query,
        "op5_minhash_near_dedup": near_dedup.query,
        "op6_exact_topk": topk.query,
        "op7_quality_classifier": quality.query,
        "op8_document_fingerprints": fingerprints.query,
        "op9_chat_formatting": chat.query,
        "op10_mixing": mixing.query,
        "op11_embedding_whitening": whitening.query,
        "op12_html_extraction": html_text.query,
        "op13_spelling_variants": spelling.query,
    }


def oracle_sql():
    return {
        "op4_secret_scans": secrets.ORACLE,
        "op6_exact_topk": topk.ORACLE,
        "op9_chat_formatting": chat.ORACLE,
        "op10_mixing": mixing.ORACLE,
    }
