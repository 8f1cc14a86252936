"""Column contracts of the four reports and of the test-data sheets they are held against.

Fixed values: sheet column names and codes, as the sheets have them.
"""

from __future__ import annotations

from dataclasses import dataclass

TEST_DATA_HEADER_ROW, REPORT_HEADER_ROW = 5, 1
TEST_ID, TEST_NO, TXN_DATE = "Transaction ID/ Reconcile ID", "Test No.", "Txn Date"
FROM_ACCOUNT, FROM_CCY, TO_CCY = "From Account (A/C Client/Sender)", "From Currency (CCY)", "To Currency (CCY)"
SETTLED_CCY, SETTLED_AMOUNT = "Settled Currency (CCY)", "Settled Amount (CCY)"
DEBIT_AMOUNT, TRANSFER_AMOUNT, PURPOSE = "From Debit Amount", "From Transfer Amount", "From BOT Purpose code"
RESIDENCE, TO_ACCOUNT_TYPE = "From Customer (Resident/Non Resident)", "To Account Type (Beneficiary)"
CIF_NO, CIF_NAME, TO_CIF_NO, TO_CIF_NAME, TO_REGION = "From CIF No. (Client/Sender)", "From CIF Name (Client/Sender)", "To CIF No. (Beneficiary)", "To CIF Name (Beneficiary)", "To Region (Bene Country)"
CUSTOMER_TYPE, CUSTOMER_TYPE_NAME = "From Customer Type Code", "From Customer Type Description"

PAYMENT_CORE = (TXN_DATE, FROM_ACCOUNT, FROM_CCY, DEBIT_AMOUNT, TRANSFER_AMOUNT, "From THB Equivalent Transfer Amount", PURPOSE, "To Credit Amount (To Amount)", "To THB Equivalent Transfer Amount", "Payment rail", "From Account Type", TO_ACCOUNT_TYPE)
PAYMENT_CUSTOMER = (TO_CIF_NAME, TO_REGION, RESIDENCE, CIF_NO, CIF_NAME)


def fee_headers(slot: int) -> tuple[str, str, str]:
    """Type, account and amount of a fee slot; the first amount is named differently."""
    return f"Fee Type {slot}", f"Fee Charge Account No. Type {slot}", "Fee Amount Type 1" if slot == 1 else f"Fee Amount {slot}"


def fee_aliases(slots: int) -> dict[str, list[str]]:
    """Each fee amount may be headed with or without `Type`."""
    return {fee_headers(i)[2]: [f"Fee Amount Type {i}", f"Fee Amount {i}"] for i in range(1, slots + 1)}


ALIASES = {TXN_DATE: ["Txn Date", "Transaction Date"], "Currency Id": ["Currency Id", "Currency ID"], "CMF CODE": ["CMF CODE", "CMF Code"]}


@dataclass(frozen=True)
class Contract:
    code: str
    report: tuple[str, ...]
    core: tuple[str, ...]
    customer: tuple[str, ...]
    fee_slots: int = 0
    sheet: str | None = None

    def test_data(self) -> tuple[str, ...]:
        return (TEST_ID, *self.core, *self.customer, *(h for i in range(1, self.fee_slots + 1) for h in fee_headers(i)))


CONTRACTS = {
    c.code: c
    for c in (
        Contract(
            "DS_LTX",
            (
                "Reference Transaction Number", "Transaction Date", "Currency Id", "FI Arrangement Number", "Loan Deposit Transaction Type", "Transaction Amount", "Outflow Transaction Purpose",
                "Payment Method", "From Transaction Type", "To Transaction Type", "Inflow Transaction Purpose", "Installment Number", "Beneficiary or Sender Name", "Country Id of Beneficiary or Sender",
                "Relationship with Beneficiary or Sender", "Approval Document Number", "Cust Code", "CMF CODE", "Cust Name", "Data Set Date", "Data Submission Period",
            ),
            (TEST_NO, *PAYMENT_CORE), PAYMENT_CUSTOMER, 5,
        ),
        Contract(
            "DS_PTX",
            (
                "Reference Transaction Number", "Receive Payment Transaction Date", "Currency Id", "Transaction Amount in Foreign Currency", "Cust Code", "CMF CODE", "Cust Name", "Involved Party Id",
                "Involved Party Name", "Country Id of Involved Party",
            ),
            PAYMENT_CORE, PAYMENT_CUSTOMER, 2, "DS_PTX",
        ),
        Contract("DS_FTX", ("Ref. TX No.", "Buy Currency Id", "Sell Currency Id", "Transaction Date"), (FROM_CCY, TO_CCY, SETTLED_CCY, SETTLED_AMOUNT, TXN_DATE, CUSTOMER_TYPE, TEST_NO, CUSTOMER_TYPE_NAME), (), 0, "DS_FTX"),
        Contract(
            "DS_FTU",
            ("Arr Number", "Data Set Date", "Leg Type", "Inflow Transaction Purpose", "Outflow Transaction Purpose", "Country Id of Beneficiary Involved Party", "Currency Id", "Foreign Currency Amount"),
            (TEST_NO, TXN_DATE, FROM_CCY, TO_CCY, SETTLED_CCY, SETTLED_AMOUNT, PURPOSE), (),
        ),
    )
}
#: The first columns of a result sheet; the report's own columns follow.
RESULT_SHEETS = {code: ("Test Script No.", "Test Result." if code in ("DS_LTX", "DS_FTU") else "Result", "Remark") for code in CONTRACTS}
#: Known reports without required columns yet: they may be asked for, and are refused by name.
STUBS = ("DF_FXU", "DF_OLB", "DF_FXM")

#: What the validation sheet says about a cell; the second and third stand in blank cells for whoever fills them in.
HAS_VALUE, REQUIRED_MESSAGE, CHECK_MESSAGE = "Field has value", "โปรดกรอกข้อมูล", "โปรดตรวจสอบข้อมูล"
#: Parts of remarks.
MUST_BE, PLEASE_REVIEW, NOT_FOUND_TEXT = "ต้องเป็น", "Please review", "ไม่พบข้อมูล"

#: What FTU remarks say of a row that must be found, and why another one must not be, and is not or is.
FTU_BUY, FTU_SELL = "Buy Foreign Currency — ต้องพบใน DS_FTU", "Sell Foreign Currency — ต้องพบใน DS_FTU"
FTU_NO_THB, FTU_LIMIT, FTU_EXCEPTION = "ธุรกรรมไม่มีขา THB", ("มูลค่า ", " USD >= 50,000 USD"), ("เข้าเงื่อนไข FTX Exception (", ")")
FTU_ABSENT, FTU_PRESENT = " — ไม่ควรพบใน DS_FTU", " แต่พบใน DS_FTU โดยไม่ควรพบ"

RELATIONSHIP_OTHER = "172064"
PAYMENT_METHOD, TRANSACTION_TYPE, ITEM_TYPE = "234004", "270001", "268002"
LEG_BUY, LEG_SELL = "182001", "182002"
USD_LIMIT = 50_000.0
COUNTRY_OF = {"USD": "US", "EUR": "DE", "JPY": "JP", "GBP": "GB", "SGD": "SG", "AUD": "AU"}
