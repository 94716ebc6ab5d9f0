"""The queries of these operators over the driver's tables, and their SQL."""

from __future__ import annotations

from sensorlake.llm.chat import op10_chat
from sensorlake.llm.decontaminate import op5_decontaminate
from sensorlake.llm.divergence import OP12_SQL, op12_divergence
from sensorlake.llm.language import op4_langid
from sensorlake.llm.lines import OP11_SQL, op11_lines
from sensorlake.llm.mixing import op9_mix
from sensorlake.llm.neighbours import op7_neighbours
from sensorlake.llm.quality import op3_quality
from sensorlake.llm.repair import op13_repair
from sensorlake.llm.repeats import op6_repeats
from sensorlake.llm.simhash import op8_simhash
from sensorlake.llm.tokenfile import op2_tokens
from sensorlake.llm.warc import OP1_SQL, op1_warc

CATALOG = {
    "op1_warc": op1_warc,
    "op2_tokens": op2_tokens,
    "op3_quality": op3_quality,
    "op4_langid": op4_langid,
    "op5_decontaminate": op5_decontaminate,
    "op6_repeats": op6_repeats,
    "op7_neighbours": op7_neighbours,
    "op8_simhash": op8_simhash,
    "op9_mix": op9_mix,
    "op10_chat": op10_chat,
    "op11_lines": op11_lines,
    "op12_divergence": op12_divergence,
    "op13_repair": op13_repair,
}

ORACLE: dict[str, str] = {"op1_warc": OP1_SQL, "op11_lines": OP11_SQL, "op12_divergence": OP12_SQL}
