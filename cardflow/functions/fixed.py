"""Values that must equal the reference's for right results.

Fixed values: reject texts, character classes, accepted flags and file
names, stated once here in the order the rules apply.
"""

# Character classes used by the rules.
# CUSTOMER_ID must not hold letters or these specials (a '-' is allowed).
ID_CHARS = r"[a-zA-Z!@#$%^&*()_+={}\[\]:;<>,.?~\\/ ]"
# Names, places and purposes must not hold digits or these specials (a space is allowed).
ALPHA_ONLY_CHARS = r"[0-9!@#$%^&*()_+={}\[\]:;<>,.?~\\/]"
# Account ids, card, cycle day and default count: no letters, '-', space or specials.
ACCOUNT_CHARS = r"[a-zA-Z-!@#$%^&*()_+={}\[\]:;<>,.?~\\/ ]"

# Customer reject texts, in rule order.
CUSTOMER_DUPLICATE = "Record is rejected due to duplicate Customer Id"
CUSTOMER_NULL = "Record is rejected due to NULL value in the column"
CUSTOMER_ALPHA = "Record is rejected due to presence of alpha or special characters in CUSTOMER_ID/DOB fields"
CUSTOMER_NUMBER = "Record is rejected as integer and special character found in fields which should only have Alphabets"
CUSTOMER_PEP = "The customer does not satisfy PEP exposed condition"
CUSTOMER_SANCTIONED = "Customer is from country which comes under sanctioned category"
CUSTOMER_NEGATIVE_INCOME = "The annual income mentioned is negative"

# Account reject texts, in rule order.
ACCOUNT_DUPLICATE = "Record is rejected due to duplicate Customer Id"
ACCOUNT_NULL = "Record is rejected due to NULL value in the column"
ACCOUNT_CLOSED = "Account for this customer has already bee closed"
ACCOUNT_SPECIAL = "special character present in one of the column"
ACCOUNT_CARD = "card nummber is not valid"

# Transaction reject texts, in rule order.
TRANSACTION_DUPLICATE = "Record is rejected due to presence of duplicate transaction"
TRANSACTION_NULL = "Record is rejected due to presence of null values"
TRANSACTION_NUMBER = "Record is rejected as integer and special character found in fields which should only have Alphabets"

# Fixed value: reject text of a transaction without a valid account or customer.
ORPHAN = "Transaction made through an account/card which is not registered or an Invalid transaction due to customer data not available"

# Accepted PEP flag, customer file name in the reject table, card length.
PEP_ACCEPTED = ("TRUE",)
CUSTOMER_FILE_NAME = "Customer Information"
CARD_LENGTH = 15

# Date layouts of the raw files.
DOB_FORMAT = "dd-MM-yyyy"
ACCOUNT_DATE_FORMAT = "dd-MMM-yy"
