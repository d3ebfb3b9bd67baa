"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from curvemill.llm import attribution, audio, bpe, lines, mixing, phrases, pii, quality, search, secrets, simhash, url_filter, wavelet


def queries() -> dict:
    return {
        "op1_likelihood_ratio": quality.op1_likelihood_ratio,
        "op2_audio_features": audio.op2_audio_features,
        "op3_weighted_fair_mix": mixing.op3_weighted_fair_mix,
        "op4_simhash_pigeonhole": simhash.op4_simhash_pigeonhole,
        "op5_deletion_neighbourhood": lines.op5_deletion_neighbourhood,
        "op6_information_sanitiser": pii.op6_information_sanitiser,
        "op7_redirect_equivalence": url_filter.op7_redirect_equivalence,
        "op8_offset_attribution": attribution.op8_offset_attribution,
        "op9_wavelet_shards": wavelet.op9_wavelet_shards,
        "op10_recursive_bpe": bpe.op10_recursive_bpe,
        "op11_reversed_search": search.op11_reversed_search,
        "op12_structural_secrets": secrets.op12_structural_secrets,
        "op13_toivonen_phrases": phrases.op13_toivonen_phrases,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_deletion_neighbourhood": lines.OP5_SQL,
        "op7_redirect_equivalence": url_filter.OP7_SQL,
        "op11_reversed_search": search.OP11_SQL,
        "op13_toivonen_phrases": phrases.OP13_SQL,
    }
