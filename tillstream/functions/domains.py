"""They must equal the reference's for results to match."""

# Order and payment life cycle
COMPLETED_STATUSES = ["confirmed", "shipped", "delivered"]
ORDER_STATUSES = ["pending", "confirmed", "processing", "shipped", "delivered", "cancelled", "refunded"]
PAYMENT_STATUSES = ["success", "failed", "declined", "pending", "refunded"]
PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "apple_pay", "google_pay", "bank_transfer", "crypto"]
CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD", "JPY"]

# Carts and pages
CART_ACTIONS = ["item_added", "item_removed", "quantity_updated", "cart_viewed", "cart_abandoned", "cart_saved"]
PAGE_TYPES = ["home", "category", "product_detail", "search_results", "cart", "checkout",
              "order_confirmation", "account", "wishlist"]

# Keys every record of a stream has to carry
REQUIRED_ORDER_FIELDS = ["event_id", "event_type", "event_timestamp", "session_id", "user_id", "order_id",
                         "total_amount", "items", "payment_method", "currency", "country"]
REQUIRED_PAYMENT_FIELDS = ["event_id", "payment_id", "order_id", "user_id", "amount", "currency",
                           "payment_method", "payment_status", "event_timestamp"]
REQUIRED_CLICK_FIELDS = ["event_id", "session_id", "user_id", "page_type", "event_timestamp"]
REQUIRED_CART_FIELDS = ["event_id", "session_id", "user_id", "cart_id", "action", "product_id",
                        "unit_price", "quantity", "event_timestamp"]

# Fraud and dead-letter rules
SUSPICIOUS_GATEWAY_CODES = ["59", "62", "63"]
RECOVERABLE_REASONS = ["ProvisionedThroughputExceededException", "ServiceUnavailableException", "S3 write failed"]

# Limits
MAX_ORDER_TOTAL = 50000
MAX_PAYMENT_AMOUNT = 100000
MAX_ORDER_ITEMS = 100
MAX_TIME_ON_PAGE = 3600
