"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from veriframe.llm.bpe import op7_bpe
from veriframe.llm.decontam import op4_decontaminate
from veriframe.llm.importance import op10_importance
from veriframe.llm.line_dedup import OP9_SQL, op9_line_dedup
from veriframe.llm.lm import op2_lm_score
from veriframe.llm.quality_rules import op3_quality_rules
from veriframe.llm.runs import op13_runs
from veriframe.llm.secrets import op8_secrets
from veriframe.llm.secrets import oracle as secrets_sql
from veriframe.llm.simhash import op5_simhash
from veriframe.llm.similar import op12_minhash
from veriframe.llm.unigram import op1_token_counts
from veriframe.llm.url_filter import op6_url_filter
from veriframe.llm.url_filter import oracle as url_filter_sql
from veriframe.llm.whitening import op11_whitening

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_lm_score": op2_lm_score,
    "op3_quality_rules": op3_quality_rules,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_url_filter": op6_url_filter,
    "op7_bpe": op7_bpe,
    "op8_secrets": op8_secrets,
    "op9_line_dedup": op9_line_dedup,
    "op10_importance": op10_importance,
    "op11_whitening": op11_whitening,
    "op12_minhash": op12_minhash,
    "op13_runs": op13_runs,
}

ORACLE_SQL = {"op6_url_filter": url_filter_sql(), "op8_secrets": secrets_sql(), "op9_line_dedup": OP9_SQL}
