from .columns import is_weekend, order_line_id, payment_label, top_type, whole

__all__ = ["is_weekend", "order_line_id", "payment_label", "top_type", "whole"]
