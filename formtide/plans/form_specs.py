"""Declarative silver specifications of the eight forms. Data only.

Every entry is (bronze column, silver column, cast). The casts are named in
``formtide.plans.silver.CASTS``. ``required`` lists silver columns without which a form cannot
be processed.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FormSpec:
    """How one form's bronze table becomes its silver table."""

    name: str
    columns: list[tuple[str, str, str]]
    required: list[str] = field(default_factory=list)


# Column maps of the eight forms, in output order.

ILUP = [
    ("id", "id", "text"),
    ("meta_serialNumber", "SN", "text"),
    ("data_buscar_id", "id_buscar", "text"),
    ("info_date", "data_registro", "epoch_ms"),
    ("data_regiao", "codigo_regiao", "text"),
    ("data_buscar_REGIAO", "nome_regiao", "text"),
    ("data_buscar_SETOR", "setor", "text"),
    ("data_buscar_LOGRADOURO", "logradouro", "text"),
    ("data_buscar_FREQUENCIA", "frequencia_varricao", "text"),
    ("data_buscar_EXTENSAOKM", "extensao_km", "number"),
    ("data_responsavel_setor", "responsavel_setor", "text"),
    ("data_varredor", "varredor", "text"),
    ("data_servico_executado", "equipado_epi", "text"),
    ("data_observacao", "observacao", "text"),
    ("info_userId", "operador_id", "text"),
    ("meta_location_latitude", "latitude", "number"),
    ("meta_location_longitude", "longitude", "number"),
    ("meta_registrationDate", "data_registro_dispositivo", "epoch_ms"),
    ("_processing_timestamp", "data_processamento", "timestamp"),
    ("data_foto", "foto_1_url", "text"),
    ("data_foto2", "foto_2_url", "text"),
    ("data_foto3", "foto_3_url", "text"),
]

IRSF = [
    ("id", "id_coleta", "text"),
    ("meta_serialNumber", "SN", "text"),
    ("data_buscar_veiculo_id", "id_veiculo", "text"),
    ("info_date", "data_coleta", "epoch_ms"),
    ("data_buscar_veiculo_PLACA", "placa_veiculo", "upper"),
    ("data_buscar_veiculo_TIPODEVEICULO", "tipo_veiculo", "text"),
    ("data_buscar_veiculo_MODELO", "modelo_veiculo", "text"),
    ("data_buscar_veiculo_MARCA", "marca_veiculo", "text"),
    ("data_buscar_veiculo_ANODOMODELO", "ano_modelo", "text"),
    ("data_buscar_veiculo_lIMITEDACARGAPBTT", "limite_carga_pbt", "number"),
    ("data_buscar_veiculo_lIMITEDACARGAPBTCOMTOLERANCIAT", "limite_carga_pbt_tolerancia", "number"),
    ("data_nome_motorista", "motorista", "title"),
    ("data_coletor", "coletor", "text"),
    ("data_observacao", "observacao", "text"),
    ("data_foto", "foto_1_url", "text"),
    ("data_foto2", "foto_2_url", "text"),
    ("data_foto3", "foto_3_url", "text"),
    ("info_userId", "operador_id", "text"),
    ("meta_location_latitude", "latitude", "number"),
    ("meta_location_longitude", "longitude", "number"),
    ("meta_device_name", "dispositivo", "text"),
    ("meta_registrationDate", "data_registro", "epoch_ms"),
    ("data_modelo_caminhao", "modelo_caminhao", "text"),
]

IRSRSD = [
    ("id", "id_coleta", "text"),
    ("data_dataEHoraDaVistoria", "data_hora", "epoch_or_text"),
    ("data_location_location_road", "logradouro", "text"),
    ("data_location_location_houseNumber", "numero", "number"),
    ("data_location_location_city", "municipio", "text"),
    ("data_location_location_postcode", "cep", "text"),
    ("data_location_location_country", "pais", "text"),
    ("data_rota_SETOR", "setor_rota", "text"),
    ("data_rota_LOCAL", "local_setor", "text"),
    ("data_rota_DIA", "dia_rota", "text"),
    ("data_rota_id", "id_rota", "number"),
    ("data_logradouros_setor", "logradouro_setor", "text"),
    ("data_logradouros_local", "logradouro_local", "text"),
    ("data_logradouros_itinerario", "itinerario_logradouros", "text"),
    ("data_logradouros_rua", "rua_logradouro", "text"),
    ("data_logradouros_rota", "rota_logradouro", "text"),
    ("data_logradouros_id", "id_logradouro", "number"),
    ("data_servioExecutadoConformePlanejado", "executado_planejado", "text"),
    ("data_observao", "observacao", "text"),
    ("data_foto", "foto_url", "text"),
    ("data_foto1", "foto_1_url", "text"),
    ("data_foto2", "foto_2_url", "text"),
    ("data_foto3", "foto_3_url", "text"),
    ("data_foto4", "foto_4_url", "text"),
    ("data_foto5", "foto_5_url", "text"),
    ("info_customerId", "id_inspetor", "number"),
    ("info_userId", "email_inspetor", "text"),
]

AMB = [
    ("id", "id_coleta", "text"),
    ("meta_serialNumber", "SN", "text"),
    ("info_date", "data_coleta", "epoch_ms"),
    ("data_peso_entrada", "peso_entrada_kg", "number"),
    ("data_peso_saida", "peso_saida_kg", "number"),
    ("data_peso_total", "peso_residuos_kg", "number"),
    ("data_observacao", "observacao", "text"),
    ("data_foto", "foto_1_url", "text"),
    ("data_foto2", "foto_2_url", "text"),
    ("data_foto3", "foto_3_url", "text"),
    ("info_userId", "operador_id", "text"),
    ("meta_location_latitude", "latitude", "number"),
    ("meta_location_longitude", "longitude", "number"),
    ("meta_device_name", "dispositivo", "text"),
    ("meta_registrationDate", "data_registro", "epoch_ms"),
]

IRSS = [
    ("id", "id_coleta", "text"),
    ("meta_serialNumber", "SN", "text"),
    ("info_date", "data_coleta", "epoch_ms"),
    ("data_peso_entrada", "peso_entrada_kg", "number"),
    ("data_peso_saida", "peso_saida_kg", "number"),
    ("data_peso_total", "peso_residuos_kg", "number"),
    ("data_observacao", "observacao", "text"),
    ("data_foto", "foto_1_url", "text"),
    ("data_foto2", "foto_2_url", "text"),
    ("data_foto3", "foto_3_url", "text"),
    ("info_userId", "operador_id", "text"),
    ("meta_location_latitude", "latitude", "number"),
    ("meta_location_longitude", "longitude", "number"),
    ("meta_device_name", "dispositivo", "text"),
    ("meta_registrationDate", "data_registro", "epoch_ms"),
]

IRSP = [
    ("id", "id_coleta", "text"),
    ("data_buscar_veiculos_id", "id_veiculo", "text"),
    ("data_buscar_veiculos_PLACA", "placa", "text"),
    ("meta_serialNumber", "SN", "text"),
    ("data_buscar_veiculos_TIPODEVEICULO", "tipo_veiculo", "text"),
    ("data_buscar_veiculos_MODELO", "modelo", "text"),
    ("data_buscar_veiculos_MARCA", "marca", "text"),
    ("data_buscar_veiculos_ANODOMODELO", "ano_modelo", "text"),
    ("info_date", "data_coleta", "epoch_ms"),
    ("data_peso_entrada", "peso_entrada_kg", "number"),
    ("data_peso_saida", "peso_saida_kg", "number"),
    ("data_peso_total", "peso_residuos_kg", "number"),
    ("data_observacao", "observacao", "text"),
    ("data_rotaDeColeta", "rota de coleta", "text"),
    ("data_nome_motorista", "motorista", "text"),
    ("data_coletor", "coletor", "text"),
    ("info_userId", "operador_id", "text"),
    ("data_buscar_veiculos_lIMITEDACARGAPBTT", "limit_carg_pbtt", "text"),
    ("data_buscar_veiculos_lIMITEDACARGAPBTCOMTOLERANCIAT", "limit_carg_pbtt_com_tol", "text"),
    ("meta_location_latitude", "latitude", "number"),
    ("meta_location_longitude", "longitude", "number"),
    ("meta_device_name", "dispositivo", "text"),
    ("meta_registrationDate", "data_registro", "epoch_ms"),
    ("data_foto", "foto_1_url", "text"),
    ("data_foto2", "foto_2_url", "text"),
    ("data_foto3", "foto_3_url", "text"),
]

ILUM = [
    ("id", "id_varricao", "text"),
    ("meta_serialNumber", "SN", "text"),
    ("info_date", "data_varricao", "epoch_ms"),
    ("data_localizao_coordinates_latitude", "latitude", "number"),
    ("data_localizao_coordinates_longitude", "longitude", "number"),
    ("data_localizao_location_road", "logradouro", "text"),
    ("data_localizao_location_city", "cidade", "text"),
    ("data_localizao_location_postcode", "cep", "text"),
    ("data_localizao_location_country", "pais", "text"),
    ("data_localizao_formattedValue", "endereco_completo", "text"),
    ("data_buscar_REGIAO", "regiao", "text"),
    ("data_buscar_id", "id_setor", "text"),
    ("data_buscar_SETOR", "setor", "text"),
    ("data_buscar_LOGRADOURO", "logradouro_varricao", "text"),
    ("data_buscar_FREQUENCIA", "frequencia", "text"),
    ("data_buscar_EXTENSAOKM", "extensao_km", "number"),
    ("data_responsavel_setor", "responsavel", "text"),
    ("data_servioExecutado", "servico_executado", "yes_no"),
    ("data_observacao", "observacao", "text"),
    ("data_foto", "foto_1_url", "text"),
    ("data_foto2", "foto_2_url", "text"),
    ("data_foto3", "foto_3_url", "text"),
    ("info_userId", "operador_id", "text"),
    ("meta_location_latitude", "dispositivo_latitude", "number"),
    ("meta_location_longitude", "dispositivo_longitude", "number"),
    ("meta_device_name", "dispositivo", "text"),
    ("meta_registrationDate", "data_registro", "epoch_ms"),
]

IRSV = [
    ("id", "id", "text"),
    ("data_buscar_veiculos_id", "id_veiculo", "text"),
    ("data_buscar_veiculos_PLACA", "placa", "text"),
    ("meta_serialNumber", "SN", "text"),
    ("data_buscar_veiculos_TIPODEVEICULO", "tipo_veiculo", "text"),
    ("data_buscar_veiculos_MODELO", "modelo", "text"),
    ("data_buscar_veiculos_MARCA", "marca", "text"),
    ("data_buscar_veiculos_ANODOMODELO", "ano_modelo", "text"),
    ("data_buscar_veiculos_lIMITEDACARGAPBTT", "limit_carg_pbtt", "text"),
    ("data_buscar_veiculos_lIMITEDACARGAPBTCOMTOLERANCIAT", "limit_carg_pbtt_com_tol", "text"),
    ("data_nome_motorista", "Motorista", "text"),
    ("data_coletor", "conformidade", "text"),
    ("info_date", "data_pesagem", "epoch_ms"),
    ("data_peso_entrada", "peso_entrada_kg", "number"),
    ("data_peso_saida", "peso_saida_kg", "number"),
    ("data_peso_total", "peso_liquido_kg", "number"),
    ("data_rotaDeColeta", "rota de coleta", "text"),
    ("data_foto", "foto_1_url", "text"),
    ("data_foto2", "foto_2_url", "text"),
    ("data_foto3", "foto_3_url", "text"),
    ("data_observacao", "observacao", "text"),
    ("info_userId", "operador_id", "text"),
    ("meta_location_latitude", "latitude", "number"),
    ("meta_location_longitude", "longitude", "number"),
]

FORM_SPECS = {
    spec.name: spec
    for spec in [
        FormSpec("ilup", ILUP, []),
        FormSpec("irsf", IRSF, ["data_coleta", "data_registro"]),
        FormSpec("irsrsd", IRSRSD, ["data_hora"]),
        FormSpec("amb", AMB, ["data_coleta", "data_registro"]),
        FormSpec("irss", IRSS, ["data_coleta", "data_registro"]),
        FormSpec("irsp", IRSP, ["data_coleta", "data_registro"]),
        FormSpec("ilum", ILUM, ["data_varricao", "data_registro"]),
        FormSpec("irsv", IRSV, ["data_pesagem"]),
    ]
}
