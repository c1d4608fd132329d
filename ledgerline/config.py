"""Fixed values and parameters.

Everything under "fixed values" must equal the behaviour being reproduced
(status names and transitions, topic and event names, message and
notification templates, configured limits); it is stated once, here, and
imported where used. The second block holds our own parameters for
deriving domain data from the driver's tables.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# fixed values
# ---------------------------------------------------------------------------

# order statuses; the status each order event sets; the legal transitions
ORDER_STATUSES = ["PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "CANCELLED"]
EVENT_STATUS = {
    "OrderCreated": "PENDING",
    "OrderConfirmed": "CONFIRMED",
    "OrderShipped": "SHIPPED",
    "OrderDelivered": "DELIVERED",
    "OrderCancelled": "CANCELLED",
}
LEGAL_TRANSITIONS = [
    (None, "PENDING"),
    ("PENDING", "CONFIRMED"),
    ("CONFIRMED", "SHIPPED"),
    ("SHIPPED", "DELIVERED"),
    ("PENDING", "CANCELLED"),
    ("CONFIRMED", "CANCELLED"),
]
# order commands: command → (required status, emitted event, resulting status)
COMMAND_TRANSITIONS = {
    "confirm": ("PENDING", "OrderConfirmed", "CONFIRMED"),
    "ship": ("CONFIRMED", "OrderShipped", "SHIPPED"),
    "deliver": ("SHIPPED", "OrderDelivered", "DELIVERED"),
}
MSG_WRONG_STATUS = "Cannot {op} order {oid}: current status is {status}, expected {expected}"
MSG_CANNOT_CANCEL = "Cannot cancel order {oid} in status {status}"
MSG_ALREADY_CANCELLED = "Order {oid} is already cancelled"
MSG_NOT_FOUND = "Order not found: {oid}"
MSG_ALREADY_EXISTS = "Order already exists: {oid}"

# topics and event types
ANALYTICS_TOPICS = ["order.created", "order.confirmed", "order.shipped", "order.cancelled"]
TOPIC_STATUS = {
    "order.created": "created",
    "order.confirmed": "confirmed",
    "order.shipped": "shipped",
    "order.cancelled": "cancelled",
}
ORDER_EVENTS_TOPIC = "order-events"
INVENTORY_EVENTS_TOPIC = "inventory-events"
DEAD_LETTER_TOPIC = "notification-dlq"
ENVELOPE_TYPES = ["ORDER_CREATED", "ORDER_CANCELLED", "ORDER_CONFIRMED"]
INVENTORY_RESERVED = "INVENTORY_RESERVED"
INVENTORY_RESERVATION_FAILED = "INVENTORY_RESERVATION_FAILED"

# stock commands: replies and the event each applied command records
MSG_QTY_NOT_POSITIVE = "Quantity must be positive, got {q}"
MSG_INSUFFICIENT = "Insufficient stock for {pid}: available={avail}, requested={q}"
MSG_NO_RESERVATION = "No active reservation found for orderId={oid} on product={pid}"
MSG_REPLENISH_NOT_POSITIVE = "Replenish quantity must be positive, got {q}"
MSG_ALL_RESERVED = "All {n} items reserved for order {oid}"
STOCK_EVENT_OF_KIND = {
    "reserve": "StockReserved",
    "release": "ReservationReleased",
    "confirm": "ReservationConfirmed",
    "replenish": "StockReplenished",
}
INSUFFICIENT_STOCK_PREFIX = "Insufficient stock: "
BATCH_FAILED_PREFIX = "Batch reservation failed: "
INVENTORY_FAILED_PREFIX = "Inventory reservation failed: "
PAYMENT_FAILED_PREFIX = "Payment failed: "

# order document arrays searched for skus
SKU_ARRAYS = ["items", "lineItems", "orderItems"]

# notifications
NOTIFY_ORDER_TYPES = ["OrderCreated", "OrderConfirmed", "OrderShipped", "OrderCancelled"]
NOTIFY_INVENTORY_TYPE = "InventoryLow"
NOTIFY_TEMPLATES = {
    "OrderCreated": ("Your order has been placed",
                     "Order {id} has been received and is being processed."),
    "OrderConfirmed": ("Your order is confirmed",
                       "Order {id} is confirmed and will be prepared for shipping."),
    "OrderShipped": ("Your order has shipped",
                     "Order {id} is on its way! Tracking: {tracking}"),
    "OrderCancelled": ("Your order has been cancelled",
                       "Order {id} was cancelled. Reason: {reason}"),
}
NOTIFY_DEFAULT_TEMPLATE = ("Order update", "Update on order {id}: {type}")
LOW_STOCK_SUBJECT = "Low stock alert: {name}"
LOW_STOCK_BODY = "Product '{name}' (ID: {id}) has only {remaining} units remaining. Please restock."

# configured limits
WINDOW_SECONDS = 3600          # metric window
FLUSH_SECONDS = 60             # streaming flush interval
BATCH_EVENTS = 200             # events per flush
TOP_PRODUCTS_LIMIT = 10
PAGE_SIZE = 20
RATE_LIMITS = {                # permits per 60 s
    "global": 500,             # sliding, 6 segments
    "user": 1000,              # fixed, per user
    "orders": 200,             # fixed
    "inventory": 300,          # fixed
}
RATE_WINDOW_SECONDS = 60
RATE_SEGMENTS = 6

# ---------------------------------------------------------------------------
# our parameters for deriving domain data from the driver's tables
# ---------------------------------------------------------------------------
STOCK_PER_SIZE_UNIT = 10       # initial available stock = p_size * this
LOW_STOCK_THRESHOLD = 25
EVENT_TYPE_TOPIC = {           # events.event_type -> analytics topic
    "purchase": "order.created",
    "click": "order.confirmed",
    "view": "order.shipped",
    "signup": "order.cancelled",
    "error": "order.delivered",   # unknown to the analytics topic list
}
