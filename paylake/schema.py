"""Record layouts of the three layers."""

from __future__ import annotations

from pyspark.sql import types as T

# The published record layout, in file order. CSV columns bind by
# position, so the order is part of the contract.
RAW_COLUMNS = (
    "Change_Type",
    "Covered_Recipient_Type",
    "Teaching_Hospital_CCN",
    "Teaching_Hospital_ID",
    "Teaching_Hospital_Name",
    "Covered_Recipient_Profile_ID",
    "Covered_Recipient_NPI",
    "Covered_Recipient_First_Name",
    "Covered_Recipient_Middle_Name",
    "Covered_Recipient_Last_Name",
    "Covered_Recipient_Name_Suffix",
    "Recipient_Primary_Business_Street_Address_Line1",
    "Recipient_Primary_Business_Street_Address_Line2",
    "Recipient_City",
    "Recipient_State",
    "Recipient_Zip_Code",
    "Recipient_Country",
    "Recipient_Province",
    "Recipient_Postal_Code",
    "Covered_Recipient_Primary_Type_1",
    "Covered_Recipient_Primary_Type_2",
    "Covered_Recipient_Primary_Type_3",
    "Covered_Recipient_Primary_Type_4",
    "Covered_Recipient_Primary_Type_5",
    "Covered_Recipient_Primary_Type_6",
    "Covered_Recipient_Specialty_1",
    "Covered_Recipient_Specialty_2",
    "Covered_Recipient_Specialty_3",
    "Covered_Recipient_Specialty_4",
    "Covered_Recipient_Specialty_5",
    "Covered_Recipient_Specialty_6",
    "Covered_Recipient_License_State_code1",
    "Covered_Recipient_License_State_code2",
    "Covered_Recipient_License_State_code3",
    "Covered_Recipient_License_State_code4",
    "Covered_Recipient_License_State_code5",
    "Submitting_Applicable_Manufacturer_or_Applicable_GPO_Name",
    "Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_ID",
    "Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name",
    "Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_State",
    "Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Country",
    "Total_Amount_of_Payment_USDollars",
    "Date_of_Payment",
    "Number_of_Payments_Included_in_Total_Amount",
    "Form_of_Payment_or_Transfer_of_Value",
    "Nature_of_Payment_or_Transfer_of_Value",
    "City_of_Travel",
    "State_of_Travel",
    "Country_of_Travel",
    "Physician_Ownership_Indicator",
    "Third_Party_Payment_Recipient_Indicator",
    "Name_of_Third_Party_Entity_Receiving_Payment_or_Transfer_of_Value",
    "Charity_Indicator",
    "Third_Party_Equals_Covered_Recipient_Indicator",
    "Contextual_Information",
    "Delay_in_Publication_Indicator",
    "Record_ID",
    "Dispute_Status_for_Publication",
    "Related_Product_Indicator",
    "Covered_or_Noncovered_Indicator_1",
    "Indicate_Drug_or_Biological_or_Device_or_Medical_Supply_1",
    "Product_Category_or_Therapeutic_Area_1",
    "Name_of_Drug_or_Biological_or_Device_or_Medical_Supply_1",
    "Associated_Drug_or_Biological_NDC_1",
    "Associated_Device_or_Medical_Supply_PDI_1",
    "Covered_or_Noncovered_Indicator_2",
    "Indicate_Drug_or_Biological_or_Device_or_Medical_Supply_2",
    "Product_Category_or_Therapeutic_Area_2",
    "Name_of_Drug_or_Biological_or_Device_or_Medical_Supply_2",
    "Associated_Drug_or_Biological_NDC_2",
    "Associated_Device_or_Medical_Supply_PDI_2",
    "Covered_or_Noncovered_Indicator_3",
    "Indicate_Drug_or_Biological_or_Device_or_Medical_Supply_3",
    "Product_Category_or_Therapeutic_Area_3",
    "Name_of_Drug_or_Biological_or_Device_or_Medical_Supply_3",
    "Associated_Drug_or_Biological_NDC_3",
    "Associated_Device_or_Medical_Supply_PDI_3",
    "Covered_or_Noncovered_Indicator_4",
    "Indicate_Drug_or_Biological_or_Device_or_Medical_Supply_4",
    "Product_Category_or_Therapeutic_Area_4",
    "Name_of_Drug_or_Biological_or_Device_or_Medical_Supply_4",
    "Associated_Drug_or_Biological_NDC_4",
    "Associated_Device_or_Medical_Supply_PDI_4",
    "Covered_or_Noncovered_Indicator_5",
    "Indicate_Drug_or_Biological_or_Device_or_Medical_Supply_5",
    "Product_Category_or_Therapeutic_Area_5",
    "Name_of_Drug_or_Biological_or_Device_or_Medical_Supply_5",
    "Associated_Drug_or_Biological_NDC_5",
    "Associated_Device_or_Medical_Supply_PDI_5",
    "Program_Year",
    "Payment_Publication_Date",
)

# The only two raw columns that are not text.
RAW_TYPES = {
    "Total_Amount_of_Payment_USDollars": T.DoubleType(),
    "Number_of_Payments_Included_in_Total_Amount": T.IntegerType(),
}

# Silver column -> raw column, in silver order.
SILVER_FROM_RAW = {
    "Record_ID": "Record_ID",
    "Covered_Recipient_Type": "Covered_Recipient_Type",
    "recipient_npi": "Covered_Recipient_NPI",
    "recipient_first_name": "Covered_Recipient_First_Name",
    "recipient_last_name": "Covered_Recipient_Last_Name",
    "recipient_state": "Recipient_State",
    "recipient_city": "Recipient_City",
    "physician_specialty": "Covered_Recipient_Specialty_1",
    "payer_name": "Applicable_Manufacturer_or_Applicable_GPO_Making_Payment_Name",
    "payment_amount_usd": "Total_Amount_of_Payment_USDollars",
    "payment_date_str": "Date_of_Payment",
    "payment_form": "Form_of_Payment_or_Transfer_of_Value",
    "payment_nature": "Nature_of_Payment_or_Transfer_of_Value",
    "program_year": "Program_Year",
}

# Gold columns, in order; the last two are computed.
GOLD_COLUMNS = (
    "Record_ID",
    "recipient_npi",
    "recipient_first_name",
    "recipient_last_name",
    "recipient_city",
    "recipient_state",
    "physician_specialty",
    "payer_name",
    "payment_form",
    "payment_nature",
    "program_year",
    "payment_date",
    "payment_amount_usd",
)

KEY = "Record_ID"
PARTITION_COLUMN = "payment_date"
CLUSTER_COLUMNS = ("recipient_state", "payment_nature")


def raw_schema() -> T.StructType:
    """The declared 91-field layout; every field nullable."""
    return T.StructType(
        [T.StructField(c, RAW_TYPES.get(c, T.StringType()), True) for c in RAW_COLUMNS]
    )
