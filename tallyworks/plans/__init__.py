"""Dataset programs: one module per dataset, one function per question.

Every function takes DataFrames and returns a DataFrame; nothing is shown,
counted or cached here. ``ordered=False`` leaves out the final sort where the
result feeds another step.
"""
