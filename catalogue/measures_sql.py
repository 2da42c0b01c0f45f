"""SQL text of the 118 measures, restated from their definitions."""

MEASURES = """
count(*) AS num_contractors,
CAST(coalesce(sum(ITEMS), 0) AS BIGINT) AS items_total,
CAST(coalesce(sum(NIC), 0) AS DECIMAL(28,2)) AS costs_total,
CAST(coalesce(sum(NUM_PROF_FEES), 0) AS BIGINT) AS prof_fees_total_pharm,
CAST(coalesce(sum(PROF_FEES), 0) AS DECIMAL(28,2)) AS prof_fees_pharm,
{MEDIAN} AS avg_monthly_items_pharm,
count(*) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '0 - 2000') AS band_items_0_2000,
count(*) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '2001 - 4000') AS band_items_2001_4000,
count(*) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '4001 - 6000') AS band_items_4001_6000,
count(*) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '6001 - 8000') AS band_items_6001_8000,
count(*) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '8001 - 10000') AS band_items_8001_10000,
count(*) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '10000+') AS band_items_10000,
CAST(coalesce(sum(ITEMS) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '0 - 2000'), 0) AS BIGINT) AS vol_items_0_2000,
CAST(coalesce(sum(ITEMS) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '2001 - 4000'), 0) AS BIGINT) AS vol_items_2001_4000,
CAST(coalesce(sum(ITEMS) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '4001 - 6000'), 0) AS BIGINT) AS vol_items_4001_6000,
CAST(coalesce(sum(ITEMS) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '6001 - 8000'), 0) AS BIGINT) AS vol_items_6001_8000,
CAST(coalesce(sum(ITEMS) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '8001 - 10000'), 0) AS BIGINT) AS vol_items_8001_10000,
CAST(coalesce(sum(ITEMS) FILTER (WHERE MONTHLY_DISP_VOL_BAND = '10000+'), 0) AS BIGINT) AS vol_items_10000,
count(*) FILTER (WHERE CONTRACTOR_TYPE = 'Independent') AS num_ind_pharm,
count(*) FILTER (WHERE CONTRACTOR_TYPE = 'Multiple contractor') AS num_multi_pharm,
count(*) FILTER (WHERE DIST_SELLING_DISPENSER_HIST = 'Y') AS num_dist_selling_pharm,
count(*) FILTER (WHERE START_DATE_HIST >= first_day) AS num_open_pharm,
count(*) FILTER (WHERE CLOSE_DATE_HIST <= last_day) AS num_close_pharm,
count(*) FILTER (WHERE LPS_DISPENSER_HIST = 'Y') AS num_lps_pharm,
count(*) FILTER (WHERE NUM_MUR > 0) AS num_mur_pharm,
CAST(coalesce(sum(NUM_MUR), 0) AS BIGINT) AS num_mur_total,
CAST(coalesce(sum(MUR_FEES), 0) AS DECIMAL(28,2)) AS num_mur_fee_total,
count(*) FILTER (WHERE NUM_NMS > 0) AS num_nms_pharm,
CAST(coalesce(sum(NUM_NMS), 0) AS BIGINT) AS num_nms_total,
CAST(coalesce(sum(NMS_FEES), 0) AS DECIMAL(28,2)) AS num_nms_fee_total,
count(*) FILTER (WHERE NUM_AUR_HOME > 0) AS num_aur_home_pharm,
count(*) FILTER (WHERE NUM_AUR_PREM > 0) AS num_aur_prem_pharm,
count(*) FILTER (WHERE NUM_AUR_ALL > 0) AS num_aur_all_pharm,
CAST(coalesce(sum(NUM_AUR_HOME), 0) AS BIGINT) AS num_aur_home_total_pharm,
CAST(coalesce(sum(NUM_AUR_PREM), 0) AS BIGINT) AS num_aur_prem_total_pharm,
CAST(coalesce(sum(NUM_AUR_ALL), 0) AS BIGINT) AS num_aur_all_total_pharm,
CAST(coalesce(sum(AUR_HOME), 0) AS DECIMAL(28,2)) AS num_aur_home_total_fee_pharm,
CAST(coalesce(sum(AUR_PREM), 0) AS DECIMAL(28,2)) AS num_aur_prem_total_fee_pharm,
CAST(coalesce(sum(AUR_ALL), 0) AS DECIMAL(28,2)) AS num_aur_all_total_fee_pharm,
count(*) FILTER (WHERE NUM_CUSTOM_STOMA_FEES > 0) AS num_stoma_pharm,
CAST(coalesce(sum(NUM_CUSTOM_STOMA_FEES), 0) AS BIGINT) AS num_stoma_total_pharm,
CAST(coalesce(sum(CUSTOM_STOMA_FEES), 0) AS DECIMAL(28,2)) AS num_stoma_total_fee_pharm,
count(*) FILTER (WHERE NUM_HOME_DEL > 0) AS num_home_del,
CAST(coalesce(sum(NUM_HOME_DEL), 0) AS BIGINT) AS num_home_del_total,
CAST(coalesce(sum(HOME_DEL_COST), 0) AS DECIMAL(28,2)) AS home_del_cost_total,
count(*) FILTER (WHERE FLU_ITEMS > 0) AS num_flu_pharm,
CAST(coalesce(sum(FLU_ITEMS), 0) AS BIGINT) AS flu_items_total,
CAST(coalesce(sum(FLU_COST), 0) AS DECIMAL(28,2)) AS flu_cost_total,
CAST(coalesce(sum(FLU_FEES), 0) AS DECIMAL(28,2)) AS flu_fees_total,
count(*) FILTER (WHERE EPS_ITEMS > 0) AS num_eps_pharm,
CAST(coalesce(sum(EPS_ITEMS), 0) AS BIGINT) AS eps_items_total_pharm,
count(*) FILTER (WHERE CD_FEE > 0) AS num_cd_fee,
CAST(coalesce(sum(CD_FEE), 0) AS DECIMAL(28,2)) AS cd_fee,
count(*) FILTER (WHERE CD_SCHED2_FEE > 0) AS num_cd_sched2_fee,
CAST(coalesce(sum(CD_SCHED2_FEE), 0) AS DECIMAL(28,2)) AS cd_sched2_fee,
count(*) FILTER (WHERE CD_SCHED3_FEE > 0) AS num_cd_sched3_fee,
CAST(coalesce(sum(CD_SCHED3_FEE), 0) AS DECIMAL(28,2)) AS cd_sched3_fee,
count(*) FILTER (WHERE ADD_FEE_2A > 0) AS num_add_fee_2a,
CAST(coalesce(sum(ADD_FEE_2A), 0) AS DECIMAL(28,2)) AS add_fee_2a,
count(*) FILTER (WHERE ADD_FEE_MF > 0) AS num_add_fee_mf_pharm,
CAST(coalesce(sum(ADD_FEE_MF), 0) AS DECIMAL(28,2)) AS add_fee_mf_pharm,
count(*) FILTER (WHERE EXPENSIVE_FEE > 0) AS num_expensive_fees_pharm,
CAST(coalesce(sum(NO_EXPENSIVE_FEES), 0) AS BIGINT) AS no_expensive_fees_pharm,
CAST(coalesce(sum(EXPENSIVE_FEE), 0) AS DECIMAL(28,2)) AS expensive_fee_pharm,
count(*) FILTER (WHERE OOPE_ITEM_COUNT > 0) AS num_oope_item_count_pharm,
CAST(coalesce(sum(OOPE_ITEM_COUNT), 0) AS BIGINT) AS oope_item_count_pharm,
CAST(coalesce(sum(OOPE_VAL), 0) AS DECIMAL(28,2)) AS oope_val_pharm,
count(*) FILTER (WHERE UMS_DRUGS > 0) AS num_ums_drugs_pharm,
CAST(coalesce(sum(UMS_FEES), 0) AS DECIMAL(28,2)) AS ums_fees_pharm,
CAST(coalesce(sum(UMS_DRUGS), 0) AS DECIMAL(28,2)) AS ums_drugs_pharm,
{CONSULTATIONS} AS num_cpcs_drugs_pharm,
CAST(coalesce(sum(CPCS_FEES), 0) AS DECIMAL(28,2)) AS cpcs_fees_pharm,
CAST(coalesce(sum(CPCS_DRUGS), 0) AS DECIMAL(28,2)) AS cpcs_drugs_pharm,
count(*) FILTER (WHERE HEP_C_SERVICE > 0) AS num_hep_c_service_pharm,
CAST(coalesce(sum(HEP_C_KIT), 0) AS DECIMAL(28,2)) AS hep_c_kit_pharm,
CAST(coalesce(sum(HEP_C_SERVICE), 0) AS DECIMAL(28,2)) AS hep_c_service_pharm,
count(*) FILTER (WHERE HYPTENCHECK_FEES > 0) AS num_hypten_inc,
CAST(coalesce(sum(HYPTENCHECK_FEES), 0) AS DECIMAL(28,2)) AS hyptencheck_fees,
CAST(coalesce(sum(HYPTENSET_FEES), 0) AS DECIMAL(28,2)) AS hyptenset_fees,
CAST(coalesce(sum(HYPTEN_INC), 0) AS DECIMAL(28,2)) AS hypten_inc,
count(*) FILTER (WHERE SCS_CNSLT > 0) AS num_scs_cnslt,
CAST(coalesce(sum(SCS_CNSLT), 0) AS DECIMAL(28,2)) AS scs_cnslt,
CAST(coalesce(sum(SCS_NRTPROD_CHARGE), 0) AS DECIMAL(28,2)) AS scs_nrtprod_charge,
CAST(coalesce(sum(SCS_NRTPROD_COST), 0) AS DECIMAL(28,2)) AS scs_nrtprod_cost,
CAST(coalesce(sum(SCS_SETUP), 0) AS DECIMAL(28,2)) AS scs_setup,
count(*) FILTER (WHERE SSP_FEES > 0) AS num_ssp_fees,
CAST(coalesce(sum(SSP_FEES), 0) AS DECIMAL(28,2)) AS ssp_fees,
count(*) FILTER (WHERE GPREFPATH_FEES > 0) AS num_gprefpath_fees,
CAST(coalesce(sum(GPREFPATH_FEES), 0) AS DECIMAL(28,2)) AS gprefpath_fees,
count(*) FILTER (WHERE CVDTESTREG_FEES > 0) AS num_cvdtestreg_fees,
CAST(coalesce(sum(CVDTESTREG_FEES), 0) AS DECIMAL(28,2)) AS cvdtestreg_fees,
count(*) FILTER (WHERE CVDTESTSET_FEES > 0) AS num_cvdtestset_fees,
CAST(coalesce(sum(CVDTESTSET_FEES), 0) AS DECIMAL(28,2)) AS cvdtestset_fees,
count(*) FILTER (WHERE CVDTEST_KITS > 0) AS num_cvdtest_kits,
CAST(coalesce(sum(CVDTEST_KITS), 0) AS DECIMAL(28,2)) AS cvdtest_kits,
count(*) FILTER (WHERE CVD_19_COSTS > 0) AS num_cvd_19_costs,
CAST(coalesce(sum(CVD_19_COSTS), 0) AS DECIMAL(28,2)) AS cvd_19_costs,
count(*) FILTER (WHERE CVD_19_VACCINE > 0) AS num_cvd_19_vaccine,
CAST(coalesce(sum(CVD_19_VACCINE), 0) AS DECIMAL(28,2)) AS cvd_19_vaccine,
count(*) FILTER (WHERE CVD_PREM_REFRID > 0) AS num_cvd_prem_refrid,
CAST(coalesce(sum(CVD_PREM_REFRID), 0) AS DECIMAL(28,2)) AS cvd_prem_refrid,
count(*) FILTER (WHERE DISCHARGE_MEDS > 0) AS num_discharge_meds,
CAST(coalesce(sum(DISCHARGE_MEDS), 0) AS DECIMAL(28,2)) AS discharge_meds,
count(*) FILTER (WHERE PPE_CLAIMS > 0) AS num_ppe_claims,
CAST(coalesce(sum(PPE_CLAIMS), 0) AS DECIMAL(28,2)) AS ppe_claims,
count(*) FILTER (WHERE T1C_CONSULT > 0) AS num_t1c_cnslt,
CAST(coalesce(sum(T1C_SET_UP), 0) AS DECIMAL(28,2)) AS t1c_set_up,
CAST(coalesce(sum(T1C_PROD_COST), 0) AS DECIMAL(28,2)) AS t1c_prod_cost,
CAST(coalesce(sum(T1C_CONSULT), 0) AS DECIMAL(28,2)) AS t1c_consult,
count(*) FILTER (WHERE PFCP_PAYMENT > 0) AS num_pfcp_payment,
CAST(coalesce(sum(PFCP_OPTIN), 0) AS DECIMAL(28,2)) AS pfcp_optin,
CAST(coalesce(sum(PFCP_FEES), 0) AS DECIMAL(28,2)) AS pfcp_fees,
CAST(coalesce(sum(PFCP_PAYMENT), 0) AS DECIMAL(28,2)) AS pfcp_payment,
CAST(coalesce(sum(PFCP_MONTHS), 0) AS BIGINT) AS pfcp_months,
CAST(coalesce(sum(PFCP_VAT), 0) AS DECIMAL(28,2)) AS pfcp_vat,
CAST(coalesce(sum(PFCP_UMSMIDEDUCT), 0) AS DECIMAL(28,2)) AS pfcp_umsmideduct,
CAST(coalesce(sum(PFCP_UMSMIREMUNERATION), 0) AS DECIMAL(28,2)) AS pfcp_umsmiremuneration,
CAST(coalesce(sum(PFCP_UMSMIREIMBURSEMENT), 0) AS DECIMAL(28,2)) AS pfcp_umsmireimbursement
"""
