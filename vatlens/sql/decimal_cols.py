"""Generated by tools/gen_decimal_cols.py: DECIMAL output columns of each SQL twin."""

DECIMAL_COLS = {'carry_in': ['f29_77_ant', 'c_504_orig', 'c_504', 'fm01'],
 'decl_adjust_fm01': ['fact_amt',
                      'c_520',
                      'fact_cr_sup',
                      'fact_cr_const',
                      'fact_cr_fixed',
                      'nc_cr',
                      'fact_cr',
                      'c_538',
                      'nc_amt',
                      'c_537',
                      'net_cr',
                      'special_cr',
                      'c_504_orig',
                      'c_504',
                      'fm01'],
 'decl_current': ['fact_amt',
                  'c_520',
                  'fact_cr_sup',
                  'fact_cr_const',
                  'fact_cr_fixed',
                  'nc_cr',
                  'fact_cr',
                  'c_538',
                  'nc_amt',
                  'c_537',
                  'net_cr',
                  'special_cr',
                  'c_504'],
 'decl_or_ledger': ['fact_amt',
                    'c_520',
                    'fact_cr_sup',
                    'fact_cr_const',
                    'fact_cr_fixed',
                    'nc_cr',
                    'fact_cr',
                    'c_538',
                    'nc_amt',
                    'c_537',
                    'net_cr',
                    'special_cr',
                    'c_504'],
 'decl_prior': ['f29_537_ant', 'f29_538_ant', 'f29_77_ant', 'special_cr_ant'],
 'edge_level0': ['iva_fact', 'iva_nc'],
 'hop1_by_origin': ['iva_fact_cont',
                    'iva_nc_cont',
                    'iva_fact',
                    'iva_nc',
                    'nc_cr',
                    'fact_cr',
                    'net_cr',
                    'neto_ctdo'],
 'ledger_docs': ['iva_fact', 'iva_nc', 'signed_vat'],
 'nondeclaring_issuers': ['iva_fact', 'iva_nc', 'iva_neto'],
 'observations': ['amount'],
 'phantom_edges': ['iva_fact', 'iva_nc', 'iva_neto_cv'],
 'special_credit': ['special_cr'],
 'trade_edges': ['iva_fact', 'iva_nc', 'iva_neto1', 'iva_neto_cv1'],
 'trade_edges_clamped': ['iva_fact', 'iva_nc', 'iva_neto', 'iva_neto_cv']}
