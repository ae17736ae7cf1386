"""sentinela: a Spark-native fraud-analytics lakehouse.

Bronze ingest with audit columns and a load manifest, Silver cleaning with a
quality report and constraint audits, Gold marts and top-k insights, and fraud
rules evaluated over stored tables and over event streams.

The main entry points are re-exported here; every function takes and returns
DataFrames (or a SparkSession plus paths for the layer runs).
"""

__version__ = "0.1.0"

from sentinela.operators.clean import (  # noqa: E402
    clean_clientes, clean_contas, clean_generic, clean_transacoes, drop_audit,
)
from sentinela.operators.joins import left_lookup  # noqa: E402
from sentinela.operators.marts import (  # noqa: E402
    gold_diario, gold_fraude_estado, gold_perfil_risco, gold_por_hora, insight_criticos, insight_hora_risco,
    insight_melhor_dia, insight_top_estados, vw_transacoes_completa,
)
from sentinela.operators.quality import (  # noqa: E402
    apply_defaults, audit_domains, audit_fk_orphans, audit_not_null, audit_unique, quality_report, quality_row,
)
from sentinela.operators.rules import alert_documents, batch_alerts, evaluate  # noqa: E402
from sentinela.operators.velocity import trailing_count  # noqa: E402
from sentinela.plans.medallion import register_views, run_bronze, run_gold, run_silver  # noqa: E402

__all__ = [
    "clean_clientes", "clean_contas", "clean_generic", "clean_transacoes", "drop_audit",
    "left_lookup",
    "gold_diario", "gold_fraude_estado", "gold_perfil_risco", "gold_por_hora", "insight_criticos",
    "insight_hora_risco", "insight_melhor_dia", "insight_top_estados", "vw_transacoes_completa",
    "apply_defaults", "audit_domains", "audit_fk_orphans", "audit_not_null", "audit_unique", "quality_report",
    "quality_row",
    "alert_documents", "batch_alerts", "evaluate", "trailing_count",
    "register_views", "run_bronze", "run_gold", "run_silver",
]
