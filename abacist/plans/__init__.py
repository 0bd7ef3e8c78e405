"""Chains of operators: augmentation, rollout scoring, evaluation."""
