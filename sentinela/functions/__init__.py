"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from sentinela.functions.text import strip, title_case, digits_only, cpf_invalid
from sentinela.functions.numeric import dk_round, faixa_valor, pct
from sentinela.functions.timefn import coerce_timestamp, hour_of_day, fora_horario, epoch_micros

__all__ = [
    "strip", "title_case", "digits_only", "cpf_invalid",
    "dk_round", "faixa_valor", "pct",
    "coerce_timestamp", "hour_of_day", "fora_horario", "epoch_micros",
]
