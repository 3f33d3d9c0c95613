"""What the stored tables and columns hold, said by how this package works them out."""

from __future__ import annotations

TABLE_DOCS: dict[str, tuple[str, str]] = {
    "silver.company": ("One row for each company code that has the expected form.", "bronze.companies after set_aside; codes and names trimmed."),
    "silver.company_group_month": (
        "History of groups: a row for each company and month that the extract states a group for.",
        "bronze.group_history after collapse_duplicates; months that parse_month refuses and blank groups are in silver.quarantine.",
    ),
    "silver.contributions": ("Amounts paid in, one row for each company, month and product.", "bronze.contributions through parse_decimal and scope_filter."),
    "silver.redemptions": (
        "Amounts drawn, one row for each company, month and product.",
        "bronze.redemptions_vgbl and redemptions_pgbl through dedup_conserving and consolidate_subrows.",
    ),
    "silver.portability": ("Amounts moved between companies, with a column for either direction.", "bronze.transfers through recode and pivot_sum."),
    "silver.stock": ("Balances at the end of each month.", "bronze.stock_vgbl and stock_pgbl, stacked and typed."),
    "silver.reconciliation": ("Two sources of the same PGBL amounts side by side.", "reconcile of silver tables with bronze.pgbl_by_state summed over states."),
    "silver.dq_results": ("A row for each quality rule of the last builds.", "DQSuite.results, a slice for each layer."),
    "silver.quarantine": ("Rows that split_rejects kept out, whole, as text.", "Every bronze table that has such rules."),
    "gold.dim_calendar": ("A row for each month of the analysed period.", "dim_calendar, from the settings."),
    "gold.dim_product": ("A row for each product that is analysed.", "literal_table, from PRODUCTS."),
    "gold.dim_company": ("A row for each company.", "silver.company as it is."),
    "gold.dim_group": ("A row for each group, named as in its newest month, and one for companies without a group.", "dim_latest of silver.company_group_month."),
    "gold.bridge": ("For each company and month with any amount, the group that was in force.", "asof_join of the months of all sources with silver.company_group_month."),
    "gold.flow_fact": ("All flows of a company, month and product in one row; stored by year.", "spine_join of three silver tables, then gold.bridge."),
    "gold.stock_fact": ("Balance of a company, month and product; stored by year. Add up over companies, never over months.", "silver.stock joined with gold.bridge."),
}

COLUMN_DOCS: dict[str, str] = {
    # keys
    "cod_empresa": "Code of the company; text, so that leading zeros stay.",
    "mes_ref": "First day of the month that the row is about, as a date.",
    "ano_ref": "Year of mes_ref; facts are stored in one folder for each.",
    "ano_mes": "The month in six digits, year first, as the extracts write it.",
    "cod_produto": "Code of the product, VGBL or PGBL.",
    "cod_grupo": "Code of the group. 99999 collects companies without a real one; NAO_INFORMADO says that no month up to this one states any.",
    # names
    "nome_empresa": "Name in the list of companies.",
    "nome_empresa_no_mes": "Name in the month's row of the group history; it may differ from the list.",
    "nome_grupo": "Name of the group.",
    "nome_produto": "Name of the product in full.",
    "descricao_produto": "One sentence on the product's kind and tax.",
    # amounts
    "vl_contribuicao": "Paid in during the month; 0 where no source has the key.",
    "vl_beneficio": "Paid out as benefits during the month.",
    "vl_resgate_total": "Drawn with the contract closed.",
    "vl_resgate_parcial": "Drawn with the contract kept.",
    "vl_resgate": "vl_resgate_total plus vl_resgate_parcial.",
    "vl_resgate_pag_programado": "Drawn by schedule; kept apart from vl_resgate.",
    "vl_portab_aceita": "Moved here from other companies.",
    "vl_portab_cedida": "Moved from here to other companies.",
    "vl_flcr": "vl_contribuicao minus vl_resgate.",
    "vl_portab_liquida": "vl_portab_aceita minus vl_portab_cedida.",
    "vl_captacao_liquida": "vl_flcr plus vl_portab_liquida.",
    "vl_pmbac": "Balance held for clients when the month ended.",
    "qt_linhas_origem": "How many rows of the extract consolidate_subrows summed.",
    # flags
    "fl_grupo_generico": "True where the code is the collective one or the unknown one.",
    "fl_contribuicao_negativa": "True where vl_contribuicao was negative in the extract.",
    "fl_qtd_portab_suspeita": "True where some summed row's value per transfer is under the limit of the settings.",
    "fl_portab_negativa": "True where some summed row's value was negative.",
    "fl_pmbac_zero": "True where the extract states a balance of exactly zero.",
    "fl_tem_contribuicao": "True where silver.contributions has the key.",
    "fl_tem_resgate": "True where silver.redemptions has the key.",
    "fl_tem_portabilidade": "True where silver.portability has the key.",
    "fl_ano_completo": "True up to the last year whose twelve months are all there.",
    "fl_periodo_ytd": "True for the months that also the newest, unfinished year has.",
    # calendar
    "ano": "Year of mes_ref.",
    "mes": "Month of mes_ref, 1 to 12.",
    "trimestre": "Quarter of mes_ref, 1 to 4.",
    # attribution
    "tipo_atribuicao": "Where the group comes from: EXATA the same month, HERDADA an earlier month, NAO_INFORMADO nowhere.",
    "meses_defasagem": "How many months back the history row lies; NULL without one.",
    # reconciliation
    "tipo_conciliacao": "Which two amounts are held against each other.",
    "vl_fonte_a": "The amount in silver; NULL where only the other side has the key.",
    "vl_fonte_b": "The amount in the table by state; NULL where only silver has the key.",
    "vl_diferenca": "vl_fonte_a minus vl_fonte_b, a missing side counting 0.",
    "pc_diferenca": "Size of vl_diferenca over vl_fonte_a, with one unit at least below the line.",
    "classe_conciliacao": "Step of pc_diferenca, or which side alone has the key.",
    # quality results
    "camada": "Build that the rule belongs to: SILVER or GOLD.",
    "tabela": "Table that the rule looks at.",
    "dimensao": "Kind of quality that the rule is about.",
    "regra": "What should hold.",
    "metrica": "What is counted or computed to tell.",
    "valor": "The outcome as shown.",
    "valor_num": "The outcome as a number, where it is one.",
    "esperado": "The outcome that would satisfy the rule.",
    "status": "Verdict: OK, ALERTA, FALHA, or INFO where there is nothing to judge.",
    "acao": "What the build does with rows that break the rule.",
    "evidencia": "Commonest offending values with their counts, where the rule names any.",
    "ts_execucao": "When the build stored the row.",
    # quarantine
    "tabela_origem": "Bronze table that brought the row.",
    "motivo": "First rule that refused the row.",
    "registro_json": "All fields of the row as a JSON object, NULL ones included.",
}
