"""Output columns of the summary tables, restated from their definitions."""

COLUMNS = {
    2: """
        num_contractors num_open_pharm num_close_pharm num_lps_pharm num_ind_pharm
        num_multi_pharm num_dist_selling_pharm
    """.split(),
    3: """
        num_contractors items_total costs_total avg_monthly_items_pharm num_eps_pharm
        eps_items_total_pharm electronic_share
    """.split(),
    5: """
        num_contractors prof_fees_total_pharm prof_fees_pharm fees_per_pharmacy
        cost_per_fee num_cd_fee cd_fee num_cd_sched2_fee cd_sched2_fee num_cd_sched3_fee
        cd_sched3_fee num_add_fee_2a add_fee_2a num_add_fee_mf_pharm add_fee_mf_pharm
        num_expensive_fees_pharm no_expensive_fees_pharm expensive_fee_pharm
        num_oope_item_count_pharm oope_item_count_pharm oope_val_pharm num_discharge_meds
        discharge_meds
    """.split(),
    6: """
        num_contractors num_nms_pharm num_nms_total num_nms_fee_total num_flu_pharm_csv
        flu_items_total_csv flu_cost_total_csv flu_fees_total_csv num_hypten_inc
        hyptenset_fees hyptencheck_fees hypten_inc num_scs_cnslt scs_setup scs_cnslt
        scs_nrtprod_cost num_t1c_cnslt t1c_set_up t1c_consult t1c_prod_cost
        num_pfcp_payment pfcp_optin pfcp_fees pfcp_payment pfcp_vat pfcp_umsmideduct
        pfcp_umsmiremuneration pfcp_umsmireimbursement num_hep_c_service_pharm
        hep_c_service_pharm hep_c_kit_pharm num_mur_pharm num_mur_total num_mur_fee_total
    """.split(),
    7: """
        num_contractors num_aur_home_pharm num_aur_home_total_pharm
        num_aur_home_total_fee_pharm num_aur_prem_pharm num_aur_prem_total_pharm
        num_aur_prem_total_fee_pharm num_aur_all_pharm num_aur_all_total_pharm
        num_aur_all_total_fee_pharm num_stoma_pharm num_stoma_total_pharm
        num_stoma_total_fee_pharm
    """.split(),
    8: """
        num_contractors num_cpcs_drugs_pharm cpcs_fees_pharm cpcs_drugs_pharm
        num_gprefpath_fees gprefpath_fees num_ums_drugs_pharm ums_fees_pharm
        ums_drugs_pharm
    """.split(),
    9: """
        num_contractors num_cvdtestreg_fees cvdtestreg_fees num_cvdtestset_fees
        cvdtestset_fees num_cvdtest_kits cvdtest_kits num_cvd_19_costs cvd_19_costs
        num_cvd_19_vaccine cvd_19_vaccine num_cvd_prem_refrid cvd_prem_refrid
        num_ppe_claims ppe_claims num_home_del num_home_del_total home_del_cost_total
    """.split(),
    10: """
        num_contractors items_total costs_total avg_monthly_items_pharm num_eps_pharm
        eps_items_total_pharm electronic_share prof_fees_total_pharm prof_fees_pharm
        num_expensive_fees_pharm no_expensive_fees_pharm expensive_fee_pharm
        num_oope_item_count_pharm oope_item_count_pharm oope_val_pharm
        num_add_fee_mf_pharm add_fee_mf_pharm
    """.split(),
    11: """
        num_contractors num_aur_home_pharm num_aur_home_total_pharm
        num_aur_home_total_fee_pharm num_aur_prem_pharm num_aur_prem_total_pharm
        num_aur_prem_total_fee_pharm num_aur_all_pharm num_aur_all_total_pharm
        num_aur_all_total_fee_pharm num_stoma_pharm num_stoma_total_pharm
        num_stoma_total_fee_pharm
    """.split(),
    12: """
        num_contractors items_total costs_total num_eps_pharm eps_items_total_pharm
        electronic_share prof_fees_total_pharm prof_fees_pharm num_add_fee_mf_pharm
        add_fee_mf_pharm num_expensive_fees_pharm no_expensive_fees_pharm
        expensive_fee_pharm num_oope_item_count_pharm oope_item_count_pharm oope_val_pharm
    """.split(),
    13: """
        num_contractors num_aur_home_pharm num_aur_home_total_pharm
        num_aur_home_total_fee_pharm num_aur_prem_pharm num_aur_prem_total_pharm
        num_aur_prem_total_fee_pharm num_aur_all_pharm num_aur_all_total_pharm
        num_aur_all_total_fee_pharm num_stoma_pharm num_stoma_total_pharm
        num_stoma_total_fee_pharm
    """.split(),
    14: """
        num_contractors num_open_pharm num_close_pharm num_lps_pharm num_ind_pharm
        num_multi_pharm num_dist_selling_pharm
    """.split(),
    15: """
        num_contractors num_open_pharm num_close_pharm num_lps_pharm num_ind_pharm
        num_multi_pharm num_dist_selling_pharm
    """.split(),
    16: """
        num_contractors items_total num_eps_pharm eps_items_total_pharm electronic_share
        num_nms_pharm num_nms_total num_nms_fee_total num_flu_pharm flu_items_total
        flu_cost_total flu_fees_total num_cpcs_drugs_pharm cpcs_fees_pharm
        cpcs_drugs_pharm num_hep_c_service_pharm hep_c_service_pharm hep_c_kit_pharm
        num_hypten_inc hyptenset_fees hyptencheck_fees hypten_inc num_scs_cnslt scs_setup
        scs_cnslt scs_nrtprod_cost items_per_pharmacy
    """.split(),
    17: """
        num_contractors items_total num_eps_pharm eps_items_total_pharm electronic_share
        num_nms_pharm num_nms_total num_nms_fee_total num_flu_pharm flu_items_total
        flu_cost_total flu_fees_total num_cpcs_drugs_pharm cpcs_fees_pharm
        cpcs_drugs_pharm num_hep_c_service_pharm hep_c_service_pharm hep_c_kit_pharm
        num_hypten_inc hyptenset_fees hyptencheck_fees hypten_inc num_scs_cnslt scs_setup
        scs_cnslt scs_nrtprod_cost items_per_pharmacy
    """.split(),
    18: """
        num_contractors num_aur_home_pharm num_aur_prem_pharm num_aur_all_pharm
        num_aur_home_total_pharm num_aur_prem_total_pharm num_aur_all_total_pharm
        num_aur_home_total_fee_pharm num_aur_prem_total_fee_pharm
        num_aur_all_total_fee_pharm num_stoma_pharm num_stoma_total_pharm
        num_stoma_total_fee_pharm
    """.split(),
    19: """
        num_contractors num_aur_home_pharm num_aur_prem_pharm num_aur_all_pharm
        num_aur_home_total_pharm num_aur_prem_total_pharm num_aur_all_total_pharm
        num_aur_home_total_fee_pharm num_aur_prem_total_fee_pharm
        num_aur_all_total_fee_pharm num_stoma_pharm num_stoma_total_pharm
        num_stoma_total_fee_pharm
    """.split(),
}
